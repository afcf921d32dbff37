"""Silver -> Gold (I7, I8): the enrichment join and the demographic rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.text import label_unknown
from strata.operators.dedup import latest_per_key, newest_first
from strata.operators.skew import split_left_join


def users_enriched(api: DataFrame, cdc: DataFrame, match: str = "all", split_above: int | None = None) -> DataFrame:
    """Every API user, with the source-database record that shares its
    e-mail (case-insensitive) when there is one (C1).

    ``match="all"`` is the plain left join: an e-mail held by several
    source records repeats the API user once per record (T13; see
    ``quality.fanout_check``).  ``match="latest"`` keeps only the newest
    record per e-mail (source time, then id), so every API user appears
    exactly once.  That reduction is a ``row_number`` cut, which Spark
    applies per map task before the shuffle, so a hot e-mail collapses to
    one row per task on the record side and a hot key on the API side is
    left to AQE's skew split of the join.

    An equi-join on ``lower(email)``: Catalyst broadcasts the record side
    only when its estimated size is under the broadcast threshold, otherwise
    both sides shuffle on the key.  Records without an e-mail never match
    and are dropped before the shuffle, so no NULL-key partition forms.
    """
    if match not in ("all", "latest"):
        raise ValueError(f"match must be 'all' or 'latest', not {match!r}")
    key = "_email_key"
    records = cdc.filter(F.col("email").isNotNull()).withColumn(key, F.lower(F.col("email")))
    if match == "latest":
        records = latest_per_key(records, [key], newest_first("source_ts", "id"))
    if split_above is not None:
        named = records.select(F.col("id").alias("db_id"), "department", F.col("source_ts").alias("last_db_update"),
                               F.col(key).alias("_record_key"))
        joined = split_left_join(api, named, F.lower("email"), F.col("_record_key"), split_above)
        return joined.select("username", "full_name", "gender", "email", "birth_year", "phone", "postcode", "db_id", "department",
                             "last_db_update", F.col("ingested_at").alias("api_ingested_at"))
    a, c = api.alias("a"), records.alias("c")
    return a.join(c, F.lower(F.col("a.email")) == F.col(f"c.{key}"), "left").select(
        F.col("a.username"),
        F.col("a.full_name"),
        F.col("a.gender"),
        F.col("a.email"),
        F.col("a.birth_year"),
        F.col("a.phone"),
        F.col("a.postcode"),
        F.col("c.id").alias("db_id"),
        F.col("c.department"),
        F.col("c.source_ts").alias("last_db_update"),
        F.col("a.ingested_at").alias("api_ingested_at"),
    )


def user_stats(enriched: DataFrame, distinct_matches: bool = False, raw_groups: bool = False,
               approx_emails: float | None = None) -> DataFrame:
    """Users per (gender, department, birth year).

    Groups by the coalesced expressions, so a NULL and a literal 'unknown'
    fall in one group.  ``distinct_matches`` counts distinct db ids instead of
    matched rows, and ``raw_groups`` groups by the raw columns: together they
    are the SQL-model variant (T6, T7).  Presentation order is left to the
    reader.  ``approx_emails`` (a relative standard deviation, e.g. 0.02)
    counts distinct e-mails with a HyperLogLog++ sketch instead: fixed memory
    per group and no (group, e-mail) shuffle, at that relative error.
    """
    if raw_groups:
        grouped = enriched.groupBy("gender", "department", "birth_year")
        labels = [label_unknown("gender").alias("gender"), label_unknown("department").alias("department"),
                  F.col("birth_year")]
    else:
        grouped = enriched.groupBy(
            label_unknown("gender").alias("gender"),
            label_unknown("department").alias("department"),
            "birth_year",
        )
        labels = ["gender", "department", "birth_year"]
    matched = F.count_distinct("db_id") if distinct_matches else F.count("db_id")
    out = grouped.agg(
        F.count(F.lit(1)).alias("total_users"),
        (F.approx_count_distinct("email", approx_emails) if approx_emails else F.count_distinct("email"))
        .alias("unique_emails"),
        matched.alias("matched_db_users"),
        F.min("api_ingested_at").alias("first_seen"),
        F.max("api_ingested_at").alias("last_seen"),
    )
    if raw_groups:
        return out.select(*labels, "total_users", "unique_emails", "matched_db_users",
                          "first_seen", "last_seen")
    return out
