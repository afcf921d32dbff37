"""Registered queries over Spark's own storage and streams: keyed and landing-day tables, bounded and restarted streams, several
topics, exact rates, mergeable sketches, state comparison, skewed enrichment, the session catalog.

Each writes into a fresh folder under the session's checkpoint root and returns what a reader of the result sees.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.functions.time import millis_since_epoch, truncate
from strata.operators.quality import state_changes
from strata.operators.sketches import SketchTable, delay_sketches, figures, merged
from strata.plans import gold, silver
from strata.plans.queries import CDC_LONG, bronze_api, bronze_cdc, silver_api, silver_cdc
from strata.plans.queries_state import BRONZE_FIELDS, _early_late, _feed_slices, _slices
from strata.schemas import BRONZE_SCHEMA, CDC_USER_COLUMNS
from strata.session import materialize, scratch_path
from strata.sources import catalog
from strata.sources.bronze import to_bronze, typed_view
from strata.sources.files import as_messages
from strata.sources.keyed import KeyedTable
from strata.sources.landing import LandedTable, consume
from strata.streaming.landing import dedup_table, start_landing, start_landing_topics, start_range_dedup
from strata.streaming.progress import ProgressLog, unread
from strata.streaming.rates import RateTable, start_exact_rate

#: rows of one e-mail that a task may hold in ``gold_users_enriched_hot``
SPLIT_ABOVE = 200


def _cdc(rows: DataFrame) -> DataFrame:
    return silver.cdc_updates(rows, "ignore", CDC_LONG)


def _files(df: DataFrame, root: str, files: int, by: str = "kafka_offset") -> DataFrame:
    """The rows as a folder of files in the order of ``by``, read as a stream of one Bronze schema, two files a batch."""
    spark = df.sparkSession
    df.repartitionByRange(files, by).sortWithinPartitions(by).write.parquet(root)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(root)


# ------------------------------------------------------------- keyed tables
def q_upsert_stored(spark, sf_dir):
    """The change feed in four runs into a keyed table, the second run twice (a run that was repeated)."""
    t = KeyedTable(spark, f"{scratch_path(spark, 'keyed')}/cdc", ["id"], buckets=8)
    parts = _feed_slices(bronze_cdc, spark, sf_dir, [3, 6, 8])
    for part in (parts[0], parts[1], parts[1], parts[3], parts[2]):  # late slices change nothing in the end
        t.upsert(_cdc(part), silver.CDC_ORDER)
    return t.read().select(*CDC_USER_COLUMNS)


def q_upsert_partial_stored(spark, sf_dir):
    """Some columns of stored rows change, ids stay, new e-mails come in."""
    early, late = _feed_slices(bronze_cdc, spark, sf_dir, [6])
    cols = ["id", "name", "email", "department"]
    t = KeyedTable(spark, f"{scratch_path(spark, 'keyed')}/partial", ["email"], buckets=8)
    t.overwrite(silver.cdc_users(early, "ignore", CDC_LONG).select(*cols))
    t.upsert_columns(silver.cdc_users(late, "ignore", CDC_LONG).select(*cols), ["name", "department"])
    return t.read().select(*cols)


def q_delete_stored(spark, sf_dir):
    """Silver users without those whose newest change is a delete, removed from the stored table by key."""
    t = KeyedTable(spark, f"{scratch_path(spark, 'keyed')}/live", ["id"], buckets=8)
    t.overwrite(silver_cdc(spark, sf_dir))
    t.delete(silver_cdc(spark, sf_dir, "apply").select("id"))
    return t.read().select(*CDC_USER_COLUMNS)


# -------------------------------------------------------- landing-day Bronze
def _landed(spark, sf_dir, feed=bronze_api, shares=(3, 7)) -> LandedTable:
    t = LandedTable(spark, f"{scratch_path(spark, 'landed')}/bronze")
    for i, part in enumerate(_feed_slices(feed, spark, sf_dir, list(shares))):
        t.land(part, "run", i)
    return t


def q_landed_recent_window(spark, sf_dir):
    """The last seven days by landing time: only their folders are read."""
    from datetime import timedelta

    t = _landed(spark, sf_dir)
    newest = t.last_landed()
    rows = t.window(newest - timedelta(days=7)) if newest is not None else t.read()
    return rows.select("kafka_offset", "ingested_at")


def q_landed_incremental(spark, sf_dir):
    """Silver follows Bronze batch by batch.  The slices come in the order 2, 0, 1, so the second batch lands in days long
    past, and the first is landed again, as a replay does."""
    root = scratch_path(spark, "landed")
    bronze, t = LandedTable(spark, f"{root}/bronze"), KeyedTable(spark, f"{root}/silver", ["id"], buckets=8)
    parts = _feed_slices(bronze_cdc, spark, sf_dir, [3, 7])
    for number, part in enumerate((parts[2], parts[0], parts[1])):
        bronze.land(part, "run", number)
        consume(bronze, t, _cdc, silver.CDC_ORDER, "silver")
        if number == 0:
            bronze.land(part, "run", 0)
    assert consume(bronze, t, _cdc, silver.CDC_ORDER, "silver") == []
    return t.read().select(*CDC_USER_COLUMNS)


def q_json_messages(spark, sf_dir):
    """Silver users as JSON messages with keys, as a producer sends them, landed and read back through the Bronze envelope."""
    users = silver_api(spark, sf_dir).select("username", "email", "birth_year", "ingested_at")
    sent = as_messages(users.drop("ingested_at"), key="username").select(
        F.col("key"), "value", F.lit("users_created").alias("topic"), F.lit(0).alias("partition"),
        F.xxhash64("key").alias("offset"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"))
    t = LandedTable(spark, f"{scratch_path(spark, 'messages')}/bronze")
    t.land(to_bronze(sent, F.lit("2024-01-02 03:00:00").cast("timestamp_ntz")), "run", 0)
    fields = {"username": ("$.username",), "email": ("$.email",), "birth_year": ("$.birth_year",)}
    return typed_view(t.read(), fields, keep=("ingested_at",)).withColumn("birth_year", F.col("birth_year").cast("int"))


# ------------------------------------------------------------------ streams
class _Stop(Exception):
    pass


def _ended(query: StreamingQuery) -> bool:
    """Did the query end by itself (true) or by a failure?"""
    try:
        query.awaitTermination()
        return True
    except Exception:
        return False


def failing_at(number: int):
    """Fails once, after batch ``number`` has been written and before its checkpoint is committed."""
    left = [number]

    def after(batch_id: int) -> None:
        if left and batch_id == left[0]:
            left.clear()
            raise _Stop(f"after the write of batch {batch_id}")

    return after


def q_stream_resume(spark, sf_dir):
    """A backlog of many files in batches of two, stopped in the middle between a batch's write and its commit, and started again:
    each message once, and the backlog never one batch."""
    root = scratch_path(spark, "resume")
    stream, t, after = _files(bronze_api(spark, sf_dir), f"{root}/files", 9), LandedTable(spark, f"{root}/bronze"), failing_at(2)
    runs = []
    for _ in range(2):
        q = start_landing(stream, t, f"{root}/_checkpoint", "resume", {"availableNow": True}, after)
        runs.append(_ended(q))
    assert runs == [False, True] and max(t.heads().values()) >= 4
    return t.read().select(*BRONZE_FIELDS)


def q_stream_topics(spark, sf_dir):
    """Two feeds as two queries of one application.  The change feed's query fails in its second batch and leaves the other
    alone; started again, it catches up.  Messages, newest offsets and lag per partition, and the times that a topic's query failed."""
    root = scratch_path(spark, "topics")
    feeds = {"users_created": bronze_api(spark, sf_dir), "postgres.public.users": bronze_cdc(spark, sf_dir)}
    streams = {n: _files(df, f"{root}/files-{i}", 6) for i, (n, df) in enumerate(feeds.items())}
    tables = {n: LandedTable(spark, f"{root}/bronze-{i}") for i, n in enumerate(feeds)}
    after = {"postgres.public.users": failing_at(1)}
    failed = dict.fromkeys(feeds, 0)
    for _ in range(2):
        for n, q in start_landing_topics(spark, streams, tables, f"{root}/_checkpoints", {"availableNow": True}, after).items():
            failed[n] += not _ended(q)
    out = None
    for n, t in tables.items():
        part = unread(feeds[n], t.read()).withColumn("failures", F.lit(failed[n]))
        out = part if out is None else out.unionByName(part)
    return out


def q_stream_dedup_ranges(spark, sf_dir):
    """The feed in time order, then its last 40 % again an hour later: each message once, its first copy, in
    a table placed by offset ranges."""
    root = scratch_path(spark, "ranges")
    b = bronze_api(spark, sf_dir)
    _, late = _early_late(b)
    again = late.withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 HOUR"))
    stream = _files(b.unionByName(again), f"{root}/files", 8, "ingested_at")
    t = dedup_table(spark, f"{root}/bronze", width=20_000)
    start_range_dedup(stream, t, f"{root}/_checkpoint", "dedup_ranges", {"availableNow": True}).awaitTermination()
    return t.read().select(*BRONZE_FIELDS)


def q_stream_rate_exact(spark, sf_dir):
    """Events per minute of a stream whose files come in the order of a hash, so most rows are days late: the
    same counts as over the whole table."""
    root = scratch_path(spark, "rate")
    rows = bronze_api(spark, sf_dir).withColumn("kafka_offset", F.xxhash64("kafka_offset"))
    t = RateTable(spark, f"{root}/rate")
    start_exact_rate(_files(rows, f"{root}/files", 6), t, "kafka_ts", f"{root}/_checkpoint", "rate_exact",
                     trigger={"availableNow": True}).awaitTermination()
    return t.rate()


def q_stream_lag(spark, sf_dir):
    """What the listener saw of a stream: rows over all batches, and that no report is missing."""
    root = scratch_path(spark, "lag")
    name = f"lag_{uuid.uuid4().hex[:8]}"
    stream, t = _files(bronze_cdc(spark, sf_dir), f"{root}/files", 7), LandedTable(spark, f"{root}/bronze")
    log = ProgressLog().attach(spark)
    try:
        q = start_landing(stream, t, f"{root}/_checkpoint", name, {"availableNow": True})
        q.awaitTermination()
        run = str(q.runId)
        _await(lambda: run in log.ended)  # reports come on a thread of their own
        seen = log.frame(spark)
    finally:
        log.detach(spark)
    return seen.filter(F.col("name") == name).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.countDistinct("batch").alias("batches"), F.coalesce(F.sum("late_rows"), F.lit(0)).alias("late_rows"))


def _await(done, seconds: int = 30) -> None:
    import time

    for _ in range(seconds * 20):
        if done():
            return
        time.sleep(0.05)


# ----------------------------------------------------------------- sketches
def q_delay_sketches(spark, sf_dir):
    """Day figures from minute sketches of three batches (one of them written twice), held against the messages
    themselves: counts are equal, estimates within their stated errors."""
    b = bronze_api(spark, sf_dir)
    who = F.concat_ws("-", F.col("kafka_partition"), F.pmod(F.xxhash64("payload"), F.lit(5000)))
    t = SketchTable(spark, scratch_path(spark, "sketches"))
    for name, part in [*zip("abc", _slices(b, [3, 7])), ("b", _slices(b, [3, 7])[1])]:
        t.add(delay_sketches(part, who), name)
    day = figures(materialize(merged(t.read(), "day"), "day-sketches"), "day")
    delay = millis_since_epoch("ingested_at") - millis_since_epoch("kafka_ts")
    rows = b.select(truncate("day", "ingested_at").alias("day"), delay.alias("delay"), who.alias("who"))
    held = rows.join(day.withColumnRenamed("messages", "sketched"), "day")

    def near(column: str, q: float):
        below = F.count_if(F.col("delay") < F.col(column)) / F.count(F.lit(1))
        upto = F.count_if(F.col("delay") <= F.col(column)) / F.count(F.lit(1))
        return (below - 0.02 <= q) & (upto + 0.02 >= q)

    return held.groupBy("day").agg(
        F.first("sketched").alias("messages"),
        (near("p50_delay_ms", 0.5) & near("p95_delay_ms", 0.95) & near("p99_delay_ms", 0.99)).alias("quantiles_hold"),
        (F.abs(F.first("senders") / F.count_distinct("who") - 1) < 0.1).alias("senders_hold"))


# --------------------------------------------------------- states and skew
def q_state_compare(spark, sf_dir):
    """Users whose Silver state differs between two points of the feed, row by row on both sides."""
    early, _ = _feed_slices(bronze_cdc, spark, sf_dir, [6])
    cols = ["id", "name", "email", "department"]
    first = materialize(silver.cdc_users(early, "ignore", CDC_LONG).select(*cols), "state")
    second = materialize(silver_cdc(spark, sf_dir).select(*cols), "state")
    return state_changes(first, second, keys=["id"])


def q_gold_users_enriched_hot(spark, sf_dir):
    """The enrichment join where a third of all records hold the e-mail of one user."""
    api, cdc = materialize(silver_api(spark, sf_dir), "silver_api"), silver_cdc(spark, sf_dir)
    one = api.agg(F.min("email")).scalar()
    hot = cdc.withColumn("email", F.when(F.col("id") % 3 == 0, one).otherwise(F.col("email")))
    return gold.users_enriched(api, materialize(hot, "silver_cdc"), split_above=SPLIT_ABOVE).drop("phone", "postcode")


# ------------------------------------------------------------------ catalog
_RUNS = T.StructType([T.StructField("step", T.StringType()), T.StructField("what", T.StringType()), T.StructField("value", T.StringType())])


def q_catalog_lifecycle(spark, sf_dir):
    """A declared table in a namespace of the session catalog: created, probed, written, listed, described, one partition
    replaced, then the whole, and dropped.  A row for every step."""
    ns = f"strata_{uuid.uuid4().hex[:10]}"
    name, root = f"{ns}.users", scratch_path(spark, "catalog")
    users = silver_api(spark, sf_dir).select("username", "email", F.coalesce("gender", F.lit("none")).alias("gender"))
    users = materialize(users, "catalog-users")
    steps: list[tuple] = []

    def count(step: str) -> None:
        steps.extend((step, r["gender"], str(r["n"])) for r in spark.table(name).groupBy("gender").agg(F.count(F.lit(1)).alias("n")).collect())

    try:
        catalog.create(spark, f"{ns}.bronze", BRONZE_SCHEMA, location=f"{root}/bronze")
        steps.append(("probe", "before", str(catalog.exists(spark, name)).lower()))
        catalog.create(spark, name, users.schema, location=f"{root}/users", partition_by=("gender",))
        catalog.create(spark, name, users.schema, location=f"{root}/users", partition_by=("gender",))  # again: nothing happens
        steps.append(("probe", "after", str(catalog.exists(spark, name)).lower()))
        catalog.replace_partitions(users, name)
        count("written")
        steps += [("listed", r["table_name"], str(r["is_temporary"]).lower()) for r in catalog.tables(spark, ns).collect()]
        steps += [("described", r["col_name"], r["data_type"] + (" partition" if r["is_partition"] else ""))
                  for r in catalog.describe(spark, name).collect()]
        catalog.replace_partitions(users.filter("gender = 'male' AND username LIKE '%1'"), name)
        count("partition replaced")
        catalog.replace(spark.table(name).filter("username LIKE '%1'"), name)
        count("replaced")
        catalog.drop(spark, name)
        catalog.drop(spark, name)
        steps.append(("probe", "dropped", str(catalog.exists(spark, name)).lower()))
        steps += [("left", r["table_name"], "") for r in catalog.tables(spark, ns).collect()]
    finally:
        catalog.drop_namespace(spark, ns)
    return spark.createDataFrame(steps, _RUNS)


REGISTRY = {f.__name__[2:]: f for f in (
    q_upsert_stored, q_upsert_partial_stored, q_delete_stored, q_landed_recent_window, q_landed_incremental, q_json_messages, q_stream_resume, q_stream_topics,
    q_stream_dedup_ranges, q_stream_rate_exact, q_stream_lag, q_delay_sketches, q_state_compare, q_gold_users_enriched_hot,
    q_catalog_lifecycle)}
