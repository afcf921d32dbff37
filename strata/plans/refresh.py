"""Ordered layer run (I13): Silver for both feeds, then Gold, stop on failure."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.quality import QualityGateFailed, fanout_check, key_violations, quality_gate
from strata.operators.upsert import live_rows
from strata.plans import gold, silver
from strata.plans.stats_delta import refresh_stats
from strata.schemas import API_USER_COLUMNS, CDC_SCHEMA, CDC_USER_COLUMNS
from strata.sources.keyed import PLACE_BYTES, buckets_for
from strata.sources.tables import _FS, VersionedTable


@dataclass
class Layout:
    """Where each table lives (one folder per table)."""

    root: str
    buckets: int = 16
    files_per_bucket: int = 1
    #: envelope schema of the change feed: widen it for 64-bit ids or new fields
    cdc_schema: T.StructType = field(default_factory=lambda: CDC_SCHEMA)

    @classmethod
    def sized(cls, root: str, silver_bytes: int, bucket_bytes: int = PLACE_BYTES, **more) -> Layout:
        """As many buckets as the size the Silver tables have, or will have, asks for (``buckets`` can't
        change once a table is written)."""
        return cls(root, buckets_for(silver_bytes, bucket_bytes), **more)

    def table(self, spark: SparkSession, name: str, keys: list[str] | None = None) -> VersionedTable:
        if keys:
            return VersionedTable(spark, f"{self.root}/{name}", self.buckets, keys)
        return VersionedTable(spark, f"{self.root}/{name}")


def refresh_silver(spark: SparkSession, layout: Layout, deletes: str = "ignore") -> dict:
    api = silver.refresh(
        layout.table(spark, "bronze/api_users_raw"),
        layout.table(spark, "silver/api_users", ["username"]),
        silver.api_updates, ["username"], silver.API_ORDER, files_per_bucket=layout.files_per_bucket,
    )
    cdc = silver.refresh(
        layout.table(spark, "bronze/cdc_users_raw"),
        layout.table(spark, "silver/cdc_users", ["id"]),
        lambda b: silver.cdc_updates(b, deletes, layout.cdc_schema), ["id"], silver.CDC_ORDER,
        files_per_bucket=layout.files_per_bucket,
    )
    return {"api_users": api, "cdc_users": cdc}


def read_silver(spark: SparkSession, layout: Layout):
    api = layout.table(spark, "silver/api_users").read().select(*API_USER_COLUMNS)
    cdc_raw = layout.table(spark, "silver/cdc_users").read()
    if "is_deleted" in cdc_raw.columns:
        cdc_raw = live_rows(cdc_raw)
    return api, cdc_raw.select(*CDC_USER_COLUMNS)


def refresh_gold(spark: SparkSession, layout: Layout, match: str = "all") -> dict:
    """Gold rebuild; ``match`` picks the enrichment join (see ``gold.users_enriched``)."""
    api, cdc = read_silver(spark, layout)
    enriched_t = layout.table(spark, "gold/users_enriched")
    enriched_t.overwrite(gold.users_enriched(api, cdc, match), operation="replace")
    # the rollup reads the published table, so the join is not recomputed
    stats_t = layout.table(spark, "gold/user_stats")
    stats_t.overwrite(gold.user_stats(enriched_t.read()), operation="replace")
    return {"users_enriched": enriched_t.latest(), "user_stats": stats_t.latest()}


def _passed(layout: Layout, spark: SparkSession) -> dict:
    """Silver versions that the gate has passed last."""
    path = f"{layout.root}/_gate.json"
    fs = _FS(spark, layout.root)
    return json.loads(fs.read_text(path)) if fs.exists(path) else {}


def _unchecked(table: VersionedTable, since: int | None) -> DataFrame:
    """Rows of the buckets rewritten after a version that passed; all rows without one.  A key lies
    in one bucket, so buckets that passed and stand unchanged hold no new repetition."""
    moved = table.changed_since(since) if since is not None else None
    return table.read() if moved is None else moved[1]


def silver_checks(spark: SparkSession, layout: Layout, match: str = "all") -> dict[str, DataFrame]:
    """What must be empty before Gold is published: repeated keys in what Silver has rewritten since
    the gate last passed and, where each user may have one record only, rows added by the enrichment join."""
    api_t, cdc_t = (layout.table(spark, f"silver/{n}", [k]) for n, k in (("api_users", "username"), ("cdc_users", "id")))
    passed = _passed(layout, spark)
    checks = {"silver_api_unique_username": key_violations(_unchecked(api_t, passed.get("api")), ["username"]),
              "silver_cdc_unique_id": key_violations(_unchecked(cdc_t, passed.get("cdc")), ["id"])}
    api, cdc = read_silver(spark, layout)
    if match == "latest":
        checks["enrichment_no_fanout"] = fanout_check(api, gold.users_enriched(api, cdc, match))
    return checks


def refresh_all(spark: SparkSession, layout: Layout, deletes: str = "ignore", match: str = "all",
                incremental_gold: bool = False, checks=silver_checks) -> dict:
    """Silver for both feeds, then the quality gate, then Gold (I13, M8); a failure
    stops the run, and a failed check stops it before Gold (``QualityGateFailed``).
    ``checks(spark, layout, match)`` gives the gate's frames, None skips it.
    ``incremental_gold`` refreshes Gold from the Silver change instead of
    rebuilding it (see ``refresh_gold_incremental``)."""
    out = refresh_silver(spark, layout, deletes)
    if checks is not None and layout.table(spark, "silver/api_users").exists() \
            and layout.table(spark, "silver/cdc_users").exists():
        gate = quality_gate(checks(spark, layout, match))
        if not gate.passed:
            raise QualityGateFailed(gate)
        if checks is silver_checks:
            seen = {n: layout.table(spark, f"silver/{n}_users").latest().version for n in ("api", "cdc")}
            _FS(spark, layout.root).write_text(f"{layout.root}/_gate.json", json.dumps(seen))
    if incremental_gold:
        out.update(refresh_gold_incremental(spark, layout, match))
    else:
        out.update(refresh_gold(spark, layout, match))
    return out


_GONE = "_strata_gone"


def replace_keys(keys: list[str]):
    """``merge(combine=...)`` rule: every target row of a key present in the
    change is replaced by the change's rows for that key (a key may own
    several rows, as an API user does under the fan-out join).  Change rows
    flagged ``_strata_gone`` only take their key's rows away."""

    def combine(target: DataFrame, change: DataFrame) -> DataFrame:
        kept = target.drop(_GONE).join(change.select(*keys).distinct(), keys, "left_anti")
        return kept.unionByName(change.filter(~F.col(_GONE)).drop(_GONE))

    return combine


def _diff(then: DataFrame, now: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows only in ``then``, rows only in ``now``) over the common columns."""
    cols = [c for c in now.columns if c in set(then.columns)]
    a, b = then.select(*cols), now.select(*cols)
    return a.subtract(b), b.subtract(a)


def refresh_gold_incremental(spark: SparkSession, layout: Layout, match: str = "all") -> dict:
    """Gold refresh whose join work follows the Silver change (I7, I8 at scale).

    The enriched table is bucketed by username and records the Silver
    versions it reflects.  On the next run, the Silver buckets rewritten
    since then, diffed old against new, give the exactly changed rows: the
    changed API users and the e-mails of changed records (before and
    after).  Users to redo are those changed users plus, through a
    semi-join, every user holding one of those e-mails.  Only they are re-joined, against records pre-filtered to their
    e-mails, and their rows are replaced in the touched Gold buckets.  The
    rollup is kept by deltas of those buckets (``stats_delta``).  With no usable
    mark (first run, expired versions) it rebuilds in full.
    """
    api_t = layout.table(spark, "silver/api_users")
    cdc_t = layout.table(spark, "silver/cdc_users")
    api_head, cdc_head = api_t.latest(), cdc_t.latest()
    if api_head is None or cdc_head is None:
        return {}
    mark = json.dumps({"api": api_head.version, "cdc": cdc_head.version})
    enriched_t = layout.table(spark, "gold/users_enriched_inc", ["username"])
    head = enriched_t.latest()
    api, cdc = read_silver(spark, layout)
    seen = json.loads(head.mark) if head is not None and head.mark else None
    api_delta = cdc_delta = None
    if seen is not None:
        api_delta, cdc_delta = api_t.changed_since(seen["api"]), cdc_t.changed_since(seen["cdc"])
    if seen is None or api_delta is None or cdc_delta is None:
        enriched_t.overwrite(gold.users_enriched(api, cdc, match), operation="replace", mark=mark)
    elif (seen["api"], seen["cdc"]) == (api_head.version, cdc_head.version):
        pass  # nothing new in Silver: Gold stands as it is
    else:
        # exact changed rows: touched buckets as they were and as they are now,
        # minus what both hold (a touched bucket is mostly unchanged rows)
        api_gone, api_new = _diff(*api_delta)
        cdc_gone, cdc_new = _diff(*cdc_delta)
        emails = (
            cdc_gone.select("email").unionByName(cdc_new.select("email"))
            .filter(F.col("email").isNotNull()).select(F.lower("email").alias("_e")).distinct()
        )
        users = (
            api_gone.select("username").unionByName(api_new.select("username"))
            .unionByName(api.join(emails, F.lower(api["email"]) == emails["_e"], "left_semi").select("username"))
            .distinct()
        )
        redo = api.join(users, "username", "left_semi")
        their_emails = redo.select(F.lower("email").alias("_e")).filter(F.col("_e").isNotNull()).distinct()
        records = cdc.join(their_emails, F.lower(cdc["email"]) == their_emails["_e"], "left_semi")
        # users that left Silver have no row to redo: they go as bare keys
        rows = gold.users_enriched(redo, records, match).withColumn(_GONE, F.lit(False))
        gone = users.join(api, "username", "left_anti").withColumn(_GONE, F.lit(True))
        done = enriched_t.merge(rows.unionByName(gone, allowMissingColumns=True), ["username"],
                                combine=replace_keys(["username"]), operation="refresh", mark=mark)
        if done.version == head.version:  # nobody to redo: only the mark moves
            enriched_t._commit("mark", head.parts, enriched_t.schema(), base=head, mark=mark)
    return {"users_enriched": enriched_t.latest(), "user_stats": refresh_stats(spark, layout, enriched_t)}
