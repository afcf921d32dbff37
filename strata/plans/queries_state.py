"""Registered queries for incremental state, upserts, versioned storage,
JSON files, change feeds, streaming and quality checks.

Splits of a feed into runs use time points inside the landing span
(``split_mark``), computed by Spark as scalar subqueries over the feed.
Storage and streaming queries write into a fresh folder under the session's
checkpoint root and return what a reader of the result table sees.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.dedup import drop_duplicate_messages, duplicate_messages
from strata.operators.incremental import max_of, slice_after_target
from strata.operators.quality import constraint_violations, fanout_check, gate_counts, state_changes
from strata.operators.rollup import duplicate_keys
from strata.operators.upsert import insert_if_absent, sync_columns, upsert, upsert_columns
from strata.plans import gold, reports, silver
from strata.plans.queries import CDC_LONG, bronze_api, bronze_cdc, silver_api, silver_cdc, split_mark, table
from strata.plans.refresh import Layout, refresh_all
from strata.schemas import CDC_USER_COLUMNS, MESSAGE_ID
from strata.session import materialize, scratch_path
from strata.sources.changes import envelope_payload, initial_snapshot, snapshot_changes
from strata.sources.feeds import api_feed
from strata.sources.files import read_json_tree, write_json_lines
from strata.sources.tables import VersionedTable
from strata.streaming.ingest import start_bronze
from strata.streaming.upsert_stream import start_dedup, start_rate, start_upsert

BRONZE_FIELDS = ["kafka_topic", "kafka_partition", "kafka_offset", "kafka_ts", "ingested_at"]


def _cut_points(df: DataFrame, shares: list[int]) -> list:
    """Whole-second time points at the given tenths of the landing span, as
    literals: one aggregate over one column, two values to the driver; empty for an empty feed."""
    span = df.agg(F.min("ingested_at").alias("lo"), F.max("ingested_at").alias("hi")).first()
    if span["lo"] is None:
        return []
    seconds = int((span["hi"] - span["lo"]).total_seconds())
    return [F.lit((span["lo"] + timedelta(seconds=seconds * s // 10)).isoformat(sep=" ")).cast("timestamp_ntz")
            for s in shares]


def _slices(df: DataFrame, shares: list[int], span: DataFrame | None = None) -> list[DataFrame]:
    """Consecutive landing-time slices cut at the given tenths of the span
    (of ``span``, the same rows in a cheaper form, if given);
    rows without a landing time are in the first one.  Every slice filters on
    literal bounds (no per-slice subquery over the whole feed)."""
    marks = _cut_points(df if span is None else span, shares)
    if not marks:
        return [df] + [df.filter(F.lit(False)) for _ in shares]
    at = F.col("ingested_at")
    out = [df.filter((at <= marks[0]) | at.isNull())]
    out += [df.filter((at > lo) & (at <= hi)) for lo, hi in zip(marks, marks[1:])]
    return out + [df.filter(at > marks[-1])]


def _feed_slices(feed, spark, sf_dir, shares: list[int]) -> list[DataFrame]:
    """``_slices`` of a feed, its span taken straight from the scan: no message
    is made for it, so its rows need not be dealt to other tasks."""
    return _slices(feed(spark, sf_dir), shares, feed(spark, sf_dir, spread=False))


def _early_late(df: DataFrame, share: int = 6) -> list[DataFrame]:
    return _slices(df, [share])


# ----------------------------------------------------------- incremental
def q_high_water_mark(spark, sf_dir):
    return max_of(silver_api(spark, sf_dir), "ingested_at", "max_ts")


def q_incremental_slice(spark, sf_dir):
    b = bronze_api(spark, sf_dir)
    return b.filter(F.col("ingested_at") > split_mark(b)).select("kafka_offset", "ingested_at")


def q_slice_after_target(spark, sf_dir):
    b = bronze_api(spark, sf_dir)
    early, _ = _early_late(b)
    target = silver.api_users(early)
    return slice_after_target(b, "ingested_at", target).select("kafka_offset", "ingested_at")


# ---------------------------------------------------------------- upserts
def q_upsert_merge(spark, sf_dir):
    early, late = _feed_slices(bronze_api, spark, sf_dir, [6])
    return upsert(silver.api_users(early), silver.api_users(late), ["username"])


def q_upsert_guarded(spark, sf_dir):
    early, late = _feed_slices(bronze_cdc, spark, sf_dir, [6])
    t = silver.cdc_updates(early, "ignore", CDC_LONG)
    u = silver.cdc_updates(late, "ignore", CDC_LONG)
    return upsert(t, u, ["id"], silver.CDC_ORDER).select(*CDC_USER_COLUMNS)


def q_upsert_plain_cdc(spark, sf_dir):
    early, late = _feed_slices(bronze_cdc, spark, sf_dir, [6])
    t = silver.cdc_users(early, "ignore", CDC_LONG)
    u = silver.cdc_users(late, "ignore", CDC_LONG)
    return upsert(t, u, ["id"])


def q_upsert_partial(spark, sf_dir):
    early, late = _feed_slices(bronze_cdc, spark, sf_dir, [6])
    t = silver.cdc_users(early, "ignore", CDC_LONG).select("id", "name", "email", "department")
    u = silver.cdc_users(late, "ignore", CDC_LONG).select("email", "name", "department", "id")
    return upsert_columns(t, u, ["email"], ["name", "department"])


def q_insert_if_absent(spark, sf_dir):
    early, late = _feed_slices(bronze_cdc, spark, sf_dir, [6])
    t = silver.cdc_users(early, "ignore", CDC_LONG)
    new = silver.clean_cdc(silver.parse_cdc(late, CDC_LONG), "ignore")
    oldest_first = [F.col(c).asc_nulls_last() for c in ("source_ts", "kafka_partition", "kafka_offset")]
    return insert_if_absent(t, new, ["id"], oldest_first)


def q_schema_sync(spark, sf_dir):
    early, late = _feed_slices(bronze_api, spark, sf_dir, [6])
    old = silver.api_users(early).drop("phone").withColumn("legacy_score", F.lit(0))
    new = silver.api_users(late)
    return upsert(sync_columns(old, new), new, ["username"])


# ----------------------------------------------------- versioned storage
def q_incremental_refresh(spark, sf_dir):
    """Bronze lands in three commits; Silver runs after each and once more
    with nothing new.  The result must equal the one-pass latest state."""
    root = scratch_path(spark, "refresh")
    bronze_t = VersionedTable(spark, f"{root}/bronze_cdc")
    silver_t = VersionedTable(spark, f"{root}/silver_cdc", buckets=8, bucket_keys=["id"])
    for part in _feed_slices(bronze_cdc, spark, sf_dir, [3, 7]):
        bronze_t.append(part)
        silver.refresh(bronze_t, silver_t, lambda b: silver.cdc_updates(b, "ignore", CDC_LONG),
                       ["id"], silver.CDC_ORDER)
    silver.refresh(bronze_t, silver_t, lambda b: silver.cdc_updates(b, "ignore", CDC_LONG),
                   ["id"], silver.CDC_ORDER)
    return silver_t.read().select(*CDC_USER_COLUMNS)


def q_layered_refresh(spark, sf_dir):
    """Bronze -> Silver -> Gold in two runs over versioned tables."""
    layout = Layout(scratch_path(spark, "layers"), buckets=8)
    api_parts = _feed_slices(bronze_api, spark, sf_dir, [5])
    cdc_parts = _feed_slices(bronze_cdc, spark, sf_dir, [5])
    for a, c in zip(api_parts, cdc_parts):
        layout.table(spark, "bronze/api_users_raw").append(a)
        layout.table(spark, "bronze/cdc_users_raw").append(c)
        refresh_all(spark, layout)
    return layout.table(spark, "gold/user_stats").read()


def _incremental_gold(spark, sf_dir) -> Layout:
    """Bronze -> Silver -> Gold in two runs, Gold refreshed incrementally:
    the second run re-joins only the users its Silver change reaches."""
    layout = Layout(scratch_path(spark, "gold_inc"), buckets=8)
    api_parts = _feed_slices(bronze_api, spark, sf_dir, [5])
    cdc_parts = _feed_slices(bronze_cdc, spark, sf_dir, [5])
    for a, c in zip(api_parts, cdc_parts):
        layout.table(spark, "bronze/api_users_raw").append(a)
        layout.table(spark, "bronze/cdc_users_raw").append(c)
        refresh_all(spark, layout, incremental_gold=True)
    return layout


def q_incremental_gold_enriched(spark, sf_dir):
    return _incremental_gold(spark, sf_dir).table(spark, "gold/users_enriched_inc").read()


def q_incremental_gold_stats(spark, sf_dir):
    return _incremental_gold(spark, sf_dir).table(spark, "gold/user_stats_inc").read()


def _three_commit_bronze(spark, sf_dir) -> VersionedTable:
    t = VersionedTable(spark, scratch_path(spark, "bronze_versions"))
    for part in _feed_slices(bronze_api, spark, sf_dir, [3, 7]):
        t.append(part)
    return t


def q_as_of_version(spark, sf_dir):
    t = _three_commit_bronze(spark, sf_dir)
    return t.read(version=1).select("kafka_offset", "ingested_at")


def q_as_of_timestamp(spark, sf_dir):
    t = _three_commit_bronze(spark, sf_dir)
    first = t.commit_at(0).committed_at
    return t.read(as_of=first).select("kafka_offset", "ingested_at")


def q_snapshot_history(spark, sf_dir):
    t = _three_commit_bronze(spark, sf_dir)
    return t.history().select("version", "operation",
                              F.col("summary")["records"].cast("long").alias("records"))


def _many_small_commits(spark, sf_dir, n: int) -> VersionedTable:
    t = VersionedTable(spark, scratch_path(spark, "bronze_small"))
    for part in _feed_slices(bronze_api, spark, sf_dir, list(range(1, n))):
        t.append(part)
    return t


def q_compaction_roundtrip(spark, sf_dir):
    t = _many_small_commits(spark, sf_dir, 8)
    t.compact(target_file_bytes=134_217_728, min_input_files=5)
    return t.read().select(*BRONZE_FIELDS)


def q_compaction_files(spark, sf_dir):
    t = _many_small_commits(spark, sf_dir, 8)
    before = t.size_summary()[0]
    report = t.compact(target_file_bytes=134_217_728, min_input_files=5)
    return t.read().agg(F.count(F.lit(1)).alias("records")).select(
        F.lit(before).cast("long").alias("files_before"),
        F.lit(report["added_files"]).cast("long").alias("files_after"),
        F.lit(report["status"]).alias("status"),
        "records",
    )


def q_expire_keep_last(spark, sf_dir):
    t = VersionedTable(spark, scratch_path(spark, "bronze_expire"))
    for part in _feed_slices(bronze_api, spark, sf_dir, [2, 4, 6, 8]):
        t.append(part)
    t.expire(datetime.now(timezone.utc).replace(tzinfo=None) + timedelta(days=1), retain_last=2)
    return t.history().select("version", F.col("summary")["records"].cast("long").alias("records"))


def q_maintenance_report(spark, sf_dir):
    """Maintenance over a table list (J3), eight days on: a Bronze table of
    eight small commits is compacted and all but its last two versions
    expire; a healthy bucketed Silver table has nothing to rewrite; a missing
    table is reported, not fatal.  Rows each table still holds are counted."""
    from strata.operators.rollup import labelled_counts
    from strata.plans.maintenance import maintain

    root = scratch_path(spark, "maintenance")
    bronze_t = VersionedTable(spark, f"{root}/bronze_api")
    for part in _feed_slices(bronze_api, spark, sf_dir, list(range(1, 8))):
        bronze_t.append(part)
    silver_t = VersionedTable(spark, f"{root}/silver_cdc", buckets=8, bucket_keys=["id"])
    silver_t.overwrite(silver_cdc(spark, sf_dir))
    later = datetime.now(timezone.utc).replace(tzinfo=None) + timedelta(days=8)
    report = maintain(spark, {"bronze_api": bronze_t.root, "silver_cdc": silver_t.root,
                              "absent": f"{root}/absent"}, now=later, retain_last=2)
    held = labelled_counts({"bronze_api": bronze_t.read(), "silver_cdc": silver_t.read()}, "table", "records")
    return report.join(held, "table", "left").select(
        F.col("table").alias("table_name"), "status", "expired_versions", "records")


def q_file_inspection(spark, sf_dir):
    t = _three_commit_bronze(spark, sf_dir)
    return t.files()


def q_partition_inspection(spark, sf_dir):
    """Per-bucket records of a bucketed Silver table; bucket ids hash with
    Spark's own function, so there is no SQL twin (rows-only)."""
    t = VersionedTable(spark, scratch_path(spark, "partitions"), buckets=8, bucket_keys=["id"])
    t.overwrite(silver_cdc(spark, sf_dir))
    return t.partitions().select("bucket", "record_count", "file_count")


def q_describe_table(spark, sf_dir):
    t = VersionedTable(spark, scratch_path(spark, "describe"))
    t.append(silver_api(spark, sf_dir))
    return spark.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in t.schema().fields],
        "col_name string, data_type string",
    )


# -------------------------------------------------------- files / changes
def _api_json(spark, sf_dir) -> str:
    path = scratch_path(spark, "api_json")
    users = silver_api(spark, sf_dir).withColumn("shard", F.pmod(F.xxhash64("username"), F.lit(4)))
    # nested folders (shard=N/part-*.json), read back recursively; every task
    # writes its own rows into the shard folders, so no shard funnels into one task
    write_json_lines(users, path, partition_by=["shard"])
    return path


def q_json_scan_stats(spark, sf_dir):
    users = read_json_tree(spark, _api_json(spark, sf_dir))
    return reports.gender_spread(users.withColumn("birth_year", F.col("birth_year").cast("int")))


def q_json_scan_topk(spark, sf_dir):
    users = read_json_tree(spark, _api_json(spark, sf_dir))
    return reports.top_k(users, ["full_name", "username"], 20).select("username", "full_name", "email")


def _customer_snapshots(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    image = [
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
    ]
    before = c.filter(F.col("c_nationkey") < 15).select(*image, F.col("c_mktsegment").alias("department"))
    after = c.filter(F.col("c_nationkey") >= 5).select(
        *image,
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.col("c_mktsegment"), F.lit("-2")))
        .otherwise(F.col("c_mktsegment")).alias("department"),
    )
    return before, after


def q_cdc_from_snapshots(spark, sf_dir):
    before, after = _customer_snapshots(spark, sf_dir)
    ch = snapshot_changes(before, after, "id", 2000, ["id", "name", "email", "department"])
    return ch.select("id", "op", F.col("before.department").alias("before_department"),
                     F.col("after.department").alias("after_department"))


def q_snapshot_fold(spark, sf_dir):
    """Initial snapshot ('r') then the changes, folded with deletes applied,
    must rebuild the after snapshot."""
    before, after = _customer_snapshots(spark, sf_dir)
    cols = ["id", "name", "email", "department"]
    first = initial_snapshot(before, "id", 1000, cols)
    changes = snapshot_changes(before, after, "id", 2000, cols)

    def as_bronze(env: DataFrame, offset_base: int, landed: str) -> DataFrame:
        return envelope_payload(env, keep=["id"]).select(
            "payload",
            F.lit("postgres.public.users").alias("kafka_topic"),
            F.lit(0).alias("kafka_partition"),
            (F.col("id") + F.lit(offset_base)).cast("long").alias("kafka_offset"),
            F.lit(landed).cast("timestamp_ntz").alias("kafka_ts"),
            F.lit(landed).cast("timestamp_ntz").alias("ingested_at"),
        )

    bronze = as_bronze(first, 0, "2024-01-01 00:00:00").unionByName(
        as_bronze(changes, 10**12, "2024-01-02 00:00:00"))
    return silver.cdc_users(bronze, "apply", CDC_LONG).select(*cols)


# -------------------------------------------------------------- streaming
def _events_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    # as a pattern, the path may be a file or a folder of part files
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events[.]parquet")


def q_stream_ingest(spark, sf_dir):
    """Stream the feed into Bronze twice with one checkpoint: the second run
    finds nothing new, so Bronze holds each message once."""
    root = scratch_path(spark, "stream_ingest")
    t = VersionedTable(spark, f"{root}/bronze")
    for _ in range(2):
        q = start_bronze(api_feed(_events_stream(spark, sf_dir)), t, f"{root}/_checkpoint",
                         "bronze_api", {"availableNow": True})
        q.awaitTermination()
    return t.read().select(*BRONZE_FIELDS)


def q_stream_upsert(spark, sf_dir):
    """Bronze files streamed in four micro-batches into a guarded Silver merge."""
    root = scratch_path(spark, "stream_upsert")
    staged = f"{root}/bronze_files"
    # four micro-batches in arrival order, each written and read by every core
    cores = spark.sparkContext.defaultParallelism
    bronze_cdc(spark, sf_dir).repartitionByRange(4 * cores, "kafka_offset").write.parquet(staged)
    stream = (spark.readStream.schema(bronze_cdc(spark, sf_dir).schema)
              .option("maxFilesPerTrigger", cores).parquet(staged))
    t = VersionedTable(spark, f"{root}/silver", buckets=8, bucket_keys=["id"])
    q = start_upsert(stream, t, lambda b: silver.cdc_updates(b, "ignore", CDC_LONG), ["id"],
                     silver.CDC_ORDER, f"{root}/_checkpoint", "silver_cdc", {"availableNow": True})
    q.awaitTermination()
    return t.read().select(*CDC_USER_COLUMNS)


def q_stream_rate(spark, sf_dir):
    root = scratch_path(spark, "stream_rate")
    t = VersionedTable(spark, f"{root}/rate", buckets=4, bucket_keys=["minute"])
    q = start_rate(api_feed(_events_stream(spark, sf_dir)), t, "kafka_ts", f"{root}/_checkpoint",
                   "rate_per_minute", trigger={"availableNow": True})
    q.awaitTermination()
    return t.read()


# ------------------------------------------------------------ delivery
def _with_replay(spark, sf_dir) -> DataFrame:
    """The feed plus a replay of its last 40 % landing again an hour later
    (what a consumer restarted from old offsets produces)."""
    b = bronze_api(spark, sf_dir)
    _, late = _early_late(b)
    replay = late.withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 HOUR"))
    return b.unionByName(replay)


def q_stream_message_dedup(spark, sf_dir):
    """The feed lands in time-ordered chunks, then its last 40 % is replayed
    an hour later; the stream keeps each message once (first copy)."""
    root = scratch_path(spark, "stream_dedup")
    landing = f"{root}/landing"
    b = bronze_api(spark, sf_dir)
    _, late = _early_late(b)
    # one write per chunk, in time order: the file source picks files up in
    # arrival order, as a topic delivers them
    for part in _slices(b, [2, 4, 6, 8]):
        part.write.mode("append").parquet(landing)
    late.withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 HOUR")) \
        .write.mode("append").parquet(landing)
    stream = (spark.readStream.schema(b.schema).option("maxFilesPerTrigger", spark.sparkContext.defaultParallelism)
              .parquet(landing))
    t = VersionedTable(spark, f"{root}/bronze", buckets=8, bucket_keys=MESSAGE_ID)
    q = start_dedup(stream, t, f"{root}/_checkpoint", "bronze_dedup", {"availableNow": True})
    q.awaitTermination()
    return t.read().select(*BRONZE_FIELDS)


def q_message_dedup(spark, sf_dir):
    return drop_duplicate_messages(_with_replay(spark, sf_dir)).select(*BRONZE_FIELDS)


def q_duplicate_messages(spark, sf_dir):
    return duplicate_messages(_with_replay(spark, sf_dir))


# ---------------------------------------------------------------- quality
def q_quarantine_api(spark, sf_dir):
    return silver.api_rejects(bronze_api(spark, sf_dir)).select("kafka_offset", "reason")


def q_quarantine_cdc(spark, sf_dir):
    return silver.cdc_rejects(bronze_cdc(spark, sf_dir), CDC_LONG).select("kafka_offset", "reason")


def q_source_constraints(spark, sf_dir):
    return constraint_violations(silver_cdc(spark, sf_dir), not_null=["department"],
                                 unique=["email"], max_length={"name": 12}, key="id")


def q_idempotence(spark, sf_dir):
    """Land the same rows twice and refresh Silver after each: the second run
    merges them all again and changes nothing."""
    root = scratch_path(spark, "idempotence")
    bronze_t = VersionedTable(spark, f"{root}/bronze")
    silver_t = VersionedTable(spark, f"{root}/silver", buckets=8, bucket_keys=["id"])
    build = lambda b: silver.cdc_updates(b, "ignore", CDC_LONG)
    rows = []
    first = None
    for run in (1, 2):
        bronze_t.append(bronze_cdc(spark, sf_dir))  # the second time the same rows land again
        silver.refresh(bronze_t, silver_t, build, ["id"], silver.CDC_ORDER, overlap="3650 DAYS")
        state = silver_t.read().select(*CDC_USER_COLUMNS)
        changed = 0 if first is None else state_changes(first, state, keys=["id"]).count()
        first = state if first is None else first
        rows.append(state.agg(F.count(F.lit(1)).alias("silver_rows"))
                    .select(F.lit(run).alias("run"), "silver_rows", F.lit(changed).cast("long")
                            .alias("changed_rows")))
    return rows[0].unionByName(rows[1])


def q_quality_gate(spark, sf_dir):
    # the gate checks published Silver: build each table once, then check it
    api = materialize(silver_api(spark, sf_dir), "silver_api")
    cdc = materialize(silver_cdc(spark, sf_dir), "silver_cdc")
    enriched = gold.users_enriched(api, cdc)
    checks = {
        "silver_api_unique_username": duplicate_keys(api, ["username"]),
        "silver_cdc_unique_id": duplicate_keys(cdc, ["id"]),
        "enrichment_no_fanout": fanout_check(api, enriched),
        "cdc_email_present": cdc.filter(F.col("email").isNull()),
        "api_birth_year_known": api.filter(F.col("birth_year").isNull()),
    }
    return gate_counts(checks)


REGISTRY = {
    "high_water_mark": q_high_water_mark,
    "incremental_slice": q_incremental_slice,
    "slice_after_target": q_slice_after_target,
    "upsert_merge": q_upsert_merge,
    "upsert_guarded": q_upsert_guarded,
    "upsert_plain_cdc": q_upsert_plain_cdc,
    "upsert_partial": q_upsert_partial,
    "insert_if_absent": q_insert_if_absent,
    "schema_sync": q_schema_sync,
    "incremental_refresh": q_incremental_refresh,
    "layered_refresh": q_layered_refresh,
    "incremental_gold_enriched": q_incremental_gold_enriched,
    "incremental_gold_stats": q_incremental_gold_stats,
    "as_of_version": q_as_of_version,
    "as_of_timestamp": q_as_of_timestamp,
    "snapshot_history": q_snapshot_history,
    "compaction_roundtrip": q_compaction_roundtrip,
    "compaction_files": q_compaction_files,
    "expire_keep_last": q_expire_keep_last,
    "maintenance_report": q_maintenance_report,
    "file_inspection": q_file_inspection,
    "partition_inspection": q_partition_inspection,
    "describe_table": q_describe_table,
    "json_scan_stats": q_json_scan_stats,
    "json_scan_topk": q_json_scan_topk,
    "cdc_from_snapshots": q_cdc_from_snapshots,
    "snapshot_fold": q_snapshot_fold,
    "stream_ingest": q_stream_ingest,
    "stream_upsert": q_stream_upsert,
    "stream_rate": q_stream_rate,
    "message_dedup": q_message_dedup,
    "stream_message_dedup": q_stream_message_dedup,
    "duplicate_messages": q_duplicate_messages,
    "quarantine_api": q_quarantine_api,
    "quarantine_cdc": q_quarantine_cdc,
    "source_constraints": q_source_constraints,
    "idempotence": q_idempotence,
    "quality_gate": q_quality_gate,
}



# ------------------------------------------------ SQL surface, sorts, rebuilds
def q_sql_views_match_rate(spark, sf_dir):
    """Documented SQL over views of the Silver frames."""
    from strata.sources.views import register_views

    v = register_views({"api_users": silver_api(spark, sf_dir), "cdc_users": silver_cdc(spark, sf_dir)})
    return spark.sql(f"""
        SELECT count(*) AS total, count(c.id) AS matched,
               round(100.0D * count(c.id) / count(*), 1) AS match_pct
        FROM {v['api_users']} a LEFT JOIN {v['cdc_users']} c ON lower(a.email) = lower(c.email)""")


def q_sql_events_per_minute(spark, sf_dir):
    """``GROUP BY 1 ORDER BY 1 DESC`` with DATE_TRUNC over a Bronze view."""
    from strata.sources.views import register_views

    v = register_views({"bronze": bronze_api(spark, sf_dir)})
    return spark.sql(f"""
        SELECT CAST(date_trunc('MINUTE', kafka_ts) AS TIMESTAMP_NTZ) AS minute, count(*) AS events
        FROM {v['bronze']} GROUP BY 1 ORDER BY 1 DESC""")


def q_user_stats_sorted(spark, sf_dir):
    return reports.sorted_by(gold.user_stats(gold.users_enriched(silver_api(spark, sf_dir),
                                                                 silver_cdc(spark, sf_dir))),
                             [F.col("total_users").desc(), "gender", "department", "birth_year"])


def q_cdc_users_sorted(spark, sf_dir):
    return reports.sorted_by(silver_cdc(spark, sf_dir), ["id"])


def q_full_refresh(spark, sf_dir):
    """Incremental run on half the feed, then a full rebuild from all of
    Bronze (I11): equals the one-pass state, history keeps both versions."""
    root = scratch_path(spark, "full_refresh")
    bronze_t = VersionedTable(spark, f"{root}/bronze")
    silver_t = VersionedTable(spark, f"{root}/silver", buckets=8, bucket_keys=["id"])
    build = lambda b: silver.cdc_updates(b, "ignore", CDC_LONG)
    first, rest = _feed_slices(bronze_cdc, spark, sf_dir, [5])
    bronze_t.append(first)
    silver.refresh(bronze_t, silver_t, build, ["id"], silver.cdc_order())
    bronze_t.append(rest)
    silver.rebuild(bronze_t, silver_t, build)
    return silver_t.read().select(*CDC_USER_COLUMNS)


def q_late_field_reparse(spark, sf_dir):
    """A payload field nobody parsed yet ('nat') read from the same Bronze
    with a wider path map (I14)."""
    from strata.schemas import API_USER_PATHS

    return silver.api_users(bronze_api(spark, sf_dir), {**API_USER_PATHS, "nat": ("$.nat",)})


REGISTRY.update({
    "sql_views_match_rate": q_sql_views_match_rate,
    "sql_events_per_minute": q_sql_events_per_minute,
    "user_stats_sorted": q_user_stats_sorted,
    "cdc_users_sorted": q_cdc_users_sorted,
    "full_refresh": q_full_refresh,
    "late_field_reparse": q_late_field_reparse,
})
