"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the warehouse tables (or data Spark derives from them) in
full.  Queries that exercise storage or streaming write into a fresh folder
under the session's checkpoint root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.jsonpath import json_first
from strata.functions.time import add_interval
from strata.operators.dedup import latest_per_key, newest_first
from strata.operators.rollup import side_by_side_counts
from strata.plans import gold, reports, silver
from strata.schemas import change_envelope, row_image
from strata.session import materialize
from strata.sources.bronze import split_by_topic, spread_small_scan, to_bronze, typed_view
from strata.sources.feeds import api_feed, change_feed

# Change-feed schema for keys derived from customer keys: 64-bit ids, so the
# feed keeps working when keys pass the 32-bit range.
CDC_LONG = change_envelope(row_image(T.LongType()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------ shared frames
def bronze_api(spark, sf_dir, spread: bool = True) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return api_feed(spread_small_scan(events) if spread else events)


def bronze_cdc(spark, sf_dir, spread: bool = True) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return change_feed(spread_small_scan(orders) if spread else orders)


def silver_api(spark, sf_dir) -> DataFrame:
    return silver.api_users(bronze_api(spark, sf_dir))


def silver_cdc(spark, sf_dir, deletes: str = "ignore") -> DataFrame:
    return silver.cdc_users(bronze_cdc(spark, sf_dir), deletes, CDC_LONG)


def enriched(spark, sf_dir) -> DataFrame:
    return gold.users_enriched(silver_api(spark, sf_dir), silver_cdc(spark, sf_dir))


def split_mark(df: DataFrame, col: str = "ingested_at", share: int = 6):
    """Time point at ``share``/10 of the landing span, as a one-row frame's
    scalar subquery (no driver round trip)."""
    span = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    mark = span.select(
        add_interval(
            F.col("lo"), "SECOND",
            F.floor(F.timestamp_diff("SECOND", F.col("lo"), F.col("hi")) * share / 10).cast("long"),
        )
    )
    return mark.scalar()


# ------------------------------------------------------------- Bronze / JSON
def q_bronze_api_fields(spark, sf_dir):
    b = bronze_api(spark, sf_dir)
    return b.select(
        "kafka_topic", "kafka_partition", "kafka_offset", "kafka_ts", "ingested_at",
        F.get_json_object("payload", "$.email").alias("email"),
        json_first("payload", "$.login.username", "$.username").alias("username"),
        F.get_json_object("payload", "$.gender").alias("gender"),
    )


def q_json_first_paths(spark, sf_dir):
    p = silver.parse_api(bronze_api(spark, sf_dir))
    return p.select("kafka_offset", "first_name", "last_name", "postcode", "username", "dob", "phone")


def q_clean_strings(spark, sf_dir):
    c = silver.clean_api(silver.parse_api(bronze_api(spark, sf_dir)))
    return c.select("kafka_offset", "first_name", "last_name", "full_name", "gender", "email",
                    "username", "birth_year", "phone", "postcode")


def q_silver_api_users(spark, sf_dir):
    return silver_api(spark, sf_dir)


def q_cdc_parse_filter(spark, sf_dir):
    c = silver.clean_cdc(silver.parse_cdc(bronze_cdc(spark, sf_dir), CDC_LONG), "ignore")
    return c.select("kafka_offset", "id", "name", "email", "department", "op", "source_ts", "ingested_at")


def q_silver_cdc_users(spark, sf_dir):
    return silver_cdc(spark, sf_dir, "ignore")


def q_silver_cdc_users_apply(spark, sf_dir):
    return silver_cdc(spark, sf_dir, "apply")


def q_latest_event_per_user(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return latest_per_key(ev, ["user_id"], newest_first("ts", "event_id")).select(
        "user_id", "event_id", "ts", "event_type", "value")


def q_latest_order_per_customer(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return latest_per_key(o, ["o_custkey"], newest_first("o_orderdate", "o_orderkey")).select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")


# ------------------------------------------------------------------- Gold
def q_gold_users_enriched(spark, sf_dir):
    return enriched(spark, sf_dir)


def q_gold_users_enriched_latest(spark, sf_dir):
    return gold.users_enriched(silver_api(spark, sf_dir), silver_cdc(spark, sf_dir), match="latest")


def q_gold_user_stats(spark, sf_dir):
    return gold.user_stats(enriched(spark, sf_dir))


def q_gold_user_stats_sqlmodel(spark, sf_dir):
    return gold.user_stats(enriched(spark, sf_dir), distinct_matches=True, raw_groups=True)


# ----------------------------------------------------------------- reports
def q_unmatched_users(spark, sf_dir):
    return reports.unmatched_users(silver_api(spark, sf_dir), silver_cdc(spark, sf_dir))


def q_matched_users(spark, sf_dir):
    return reports.matched_users(enriched(spark, sf_dir))


def q_has_db_record(spark, sf_dir):
    return reports.with_db_flag(enriched(spark, sf_dir))


def q_op_frequency(spark, sf_dir):
    return reports.op_frequency(bronze_cdc(spark, sf_dir))


def q_events_per_minute(spark, sf_dir):
    return reports.events_per_minute(bronze_api(spark, sf_dir), "kafka_ts")


def q_gender_spread(spark, sf_dir):
    return reports.gender_spread(silver_api(spark, sf_dir))


def q_department_totals(spark, sf_dir):
    return reports.department_totals(gold.user_stats(enriched(spark, sf_dir)))


def q_department_match_pct(spark, sf_dir):
    return reports.department_match_pct(gold.user_stats(enriched(spark, sf_dir)))


def q_match_rate(spark, sf_dir):
    return reports.overall_match_rate(enriched(spark, sf_dir))


def q_duplicate_usernames(spark, sf_dir):
    from strata.operators.rollup import duplicate_keys

    c = silver.clean_api(silver.parse_api(bronze_api(spark, sf_dir)))
    return duplicate_keys(c, ["username"], "copies")


def q_silver_key_violations(spark, sf_dir):
    from strata.operators.quality import key_violations

    return key_violations(silver_api(spark, sf_dir), ["username"])


def q_topk_recent(spark, sf_dir):
    return reports.top_k(silver_api(spark, sf_dir),
                         [F.col("ingested_at").desc(), F.col("username").asc()], 10).select(
        "username", "email", "gender", "ingested_at")


def q_topk_by_name(spark, sf_dir):
    return reports.top_k(silver_api(spark, sf_dir), ["full_name", "username"], 20).select(
        "username", "full_name", "email")


def q_topk_by_id(spark, sf_dir):
    return reports.top_k(silver_cdc(spark, sf_dir), ["id"], 20)


def q_any_rows(spark, sf_dir):
    """Any five users: which ones is open, so how many there are and how many of them are in the table."""
    api = materialize(silver_api(spark, sf_dir), "silver_api")
    some = materialize(reports.any_rows(api, 5), "any_rows")
    return side_by_side_counts({"n_rows": some, "in_table": some.join(api, "username", "left_semi")})


def q_silver_api_users_sqlmodel(spark, sf_dir):
    return silver.api_users(bronze_api(spark, sf_dir), null_names=True)


def q_kafka_envelope(spark, sf_dir):
    """The feed in a Kafka source's shape (bytes, topic, partition, offset,
    timestamp), projected to Bronze, split by topic and read through a typed view."""
    b = bronze_api(spark, sf_dir)
    messages = b.select(
        F.col("payload").cast("binary").alias("value"), F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"),
        F.col("kafka_ts").alias("timestamp"))
    topic = split_by_topic(to_bronze(messages), ["users_created"])["users_created"]
    return typed_view(topic, {"email": ["$.email"], "username": ["$.login.username", "$.username"],
                              "gender": ["$.gender"]}, ["kafka_partition", "kafka_offset", "kafka_ts"])


def _accounted(bronze: DataFrame, kept: DataFrame, rejected: DataFrame) -> DataFrame:
    c = side_by_side_counts({"bronze": bronze, "kept": kept, "rejected": rejected})
    return c.withColumn("complete", F.col("bronze") == F.col("kept") + F.col("rejected"))


def q_api_accounted(spark, sf_dir):
    b = bronze_api(spark, sf_dir)
    return _accounted(b, silver.clean_api(silver.parse_api(b)), silver.api_rejects(b))


def q_cdc_accounted(spark, sf_dir):
    b = bronze_cdc(spark, sf_dir)
    return _accounted(b, silver.clean_cdc(silver.parse_cdc(b, CDC_LONG)), silver.cdc_rejects(b, CDC_LONG))


def q_cdc_accounted_apply(spark, sf_dir):
    b = bronze_cdc(spark, sf_dir)
    return _accounted(b, silver.clean_cdc(silver.parse_cdc(b, CDC_LONG), "apply"), silver.cdc_rejects(b, CDC_LONG, "apply"))


def q_layer_counts(spark, sf_dir):
    # counts of published layers: each layer is built once and counted from
    # its written files, as a reader of the tables would
    api = materialize(silver_api(spark, sf_dir), "silver_api")
    cdc = materialize(silver_cdc(spark, sf_dir), "silver_cdc")
    e = materialize(gold.users_enriched(api, cdc), "gold_enriched")
    return reports.layer_counts({
        "bronze_api": bronze_api(spark, sf_dir),
        "bronze_cdc": bronze_cdc(spark, sf_dir),
        "silver_api": api,
        "silver_cdc": cdc,
        "gold_enriched": e,
        "gold_stats": gold.user_stats(e),
    })


def q_bronze_vs_silver(spark, sf_dir):
    from strata.operators.quality import layer_reconciliation

    return layer_reconciliation(bronze_api(spark, sf_dir), silver_api(spark, sf_dir))


def q_partition_progress(spark, sf_dir):
    return reports.partition_progress(bronze_api(spark, sf_dir).unionByName(bronze_cdc(spark, sf_dir)))


def q_ingest_delay(spark, sf_dir):
    return reports.ingest_delay(bronze_api(spark, sf_dir), "day")


def q_ingest_delay_quantiles(spark, sf_dir):
    return reports.ingest_delay_quantiles(bronze_api(spark, sf_dir), "day")


def q_recent_window(spark, sf_dir):
    b = bronze_api(spark, sf_dir)
    latest = b.agg(F.max("ingested_at")).scalar()
    return b.filter(F.col("ingested_at") >= latest - F.expr("INTERVAL 7 DAYS")).select(
        "kafka_offset", "ingested_at")


REGISTRY = {
    "bronze_api_fields": q_bronze_api_fields,
    "json_first_paths": q_json_first_paths,
    "clean_strings": q_clean_strings,
    "silver_api_users": q_silver_api_users,
    "cdc_parse_filter": q_cdc_parse_filter,
    "silver_cdc_users": q_silver_cdc_users,
    "silver_cdc_users_apply": q_silver_cdc_users_apply,
    "latest_event_per_user": q_latest_event_per_user,
    "latest_order_per_customer": q_latest_order_per_customer,
    "gold_users_enriched": q_gold_users_enriched,
    "gold_users_enriched_latest": q_gold_users_enriched_latest,
    "gold_user_stats": q_gold_user_stats,
    "gold_user_stats_sqlmodel": q_gold_user_stats_sqlmodel,
    "unmatched_users": q_unmatched_users,
    "matched_users": q_matched_users,
    "has_db_record": q_has_db_record,
    "op_frequency": q_op_frequency,
    "events_per_minute": q_events_per_minute,
    "gender_spread": q_gender_spread,
    "department_totals": q_department_totals,
    "department_match_pct": q_department_match_pct,
    "match_rate": q_match_rate,
    "duplicate_usernames": q_duplicate_usernames,
    "silver_key_violations": q_silver_key_violations,
    "topk_recent": q_topk_recent,
    "topk_by_name": q_topk_by_name,
    "topk_by_id": q_topk_by_id,
    "any_rows": q_any_rows,
    "silver_api_users_sqlmodel": q_silver_api_users_sqlmodel,
    "kafka_envelope": q_kafka_envelope,
    "api_accounted": q_api_accounted,
    "cdc_accounted": q_cdc_accounted,
    "cdc_accounted_apply": q_cdc_accounted_apply,
    "layer_counts": q_layer_counts,
    "bronze_vs_silver": q_bronze_vs_silver,
    "partition_progress": q_partition_progress,
    "ingest_delay": q_ingest_delay,
    "ingest_delay_quantiles": q_ingest_delay_quantiles,
    "recent_window": q_recent_window,
}
