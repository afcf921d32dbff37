"""Bounded batches, restarts, several topics, range-placed dedup, exact rates and progress reports."""

import uuid

from helpers import SF_SMALL, bronze_rows, ts
from pyspark.sql import functions as F

from strata.plans import reports
from strata.plans.queries import bronze_api
from strata.plans.queries_stored import _await, _ended, failing_at
from strata.schemas import BRONZE_SCHEMA
from strata.sources.landing import LandedTable
from strata.streaming.landing import dedup_table, start_landing, start_landing_topics, start_range_dedup
from strata.streaming.progress import ProgressLog, partition_lag, unread
from strata.streaming.rates import RateTable, start_exact_rate

NOW = {"availableNow": True}


def put(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def files(spark, folder, n=1):
    return spark.readStream.schema(BRONZE_SCHEMA).option("maxFilesPerTrigger", n).parquet(folder)


def messages(spark, offsets, second=1, landed=2):
    return spark.createDataFrame([("{}", "t", 0, o, ts(second), ts(landed)) for o in offsets], BRONZE_SCHEMA)


def test_stop_between_write_and_commit(spark, tmp_path):
    """Fails after each batch's write in turn; batches stay bounded and every message is there once."""
    folder = str(tmp_path / "f")
    for k in range(6):
        put(messages(spark, range(10 * k, 10 * k + 10), landed=k), folder)
    t, ck = LandedTable(spark, str(tmp_path / "b")), str(tmp_path / "ck")
    for stop in (0, 2, 5):
        assert not _ended(start_landing(files(spark, folder), t, ck, "stops", NOW, failing_at(stop)))
    assert _ended(start_landing(files(spark, folder), t, ck, "stops", NOW))
    assert sorted(r["kafka_offset"] for r in t.read().collect()) == list(range(60))
    assert list(t.heads().values()) == [5]
    sizes = t._scan().groupBy("batch").count().collect()
    assert len(sizes) == 6 and {r["count"] for r in sizes} == {10}
    # new files under the same checkpoint; then a new checkpoint lands everything under a name of its own
    put(messages(spark, [60]), folder)
    assert _ended(start_landing(files(spark, folder), t, ck, "stops", NOW)) and t.read().count() == 61
    assert _ended(start_landing(files(spark, folder, 9), t, str(tmp_path / "ck2"), "stops", NOW)) and t.read().count() == 122


def test_one_topic_fails_the_other_runs(spark, tmp_path):
    folders = {n: str(tmp_path / n) for n in ("a", "b.c")}
    for f in folders.values():
        for k in range(3):
            put(messages(spark, range(5 * k, 5 * k + 5)), f)
    tables = {n: LandedTable(spark, str(tmp_path / f"t{i}")) for i, n in enumerate(folders)}

    def start(after=None):
        streams = {n: files(spark, f) for n, f in folders.items()}
        return start_landing_topics(spark, streams, tables, str(tmp_path / "ck"), NOW, after)

    assert [_ended(q) for q in start({"a": failing_at(1)}).values()] == [False, True]
    assert tables["b.c"].read().count() == 15
    feed = messages(spark, range(15))
    first = unread(feed, tables["a"].read()).first()
    assert first["source_offset"] == 14 and first["lag"] == 14 - first["landed_offset"]
    assert [_ended(q) for q in start().values()] == [True, True]
    assert unread(feed, tables["a"].read()).first().asDict() == {
        "kafka_topic": "t", "kafka_partition": 0, "source_offset": 14, "landed_offset": 14, "landed": 15, "lag": 0}
    assert unread(feed, feed.limit(0)).first()["lag"] == 15


def test_dedup_touches_the_newest_and_the_replayed_ranges(spark, tmp_path):
    folder, touched = str(tmp_path / "f"), {}
    for k in range(6):
        put(messages(spark, range(10 * k, 10 * k + 10), landed=10 + k), folder)
    put(messages(spark, [*range(20, 25), *range(60, 65)], landed=30), folder)  # five replayed, five new
    put(messages(spark, [3], landed=5), folder)  # an earlier copy that comes late
    t = dedup_table(spark, str(tmp_path / "t"), width=10)
    q = start_range_dedup(files(spark, folder), t, str(tmp_path / "ck"), "ranges", NOW, touched=lambda b, p: touched.update({b: sorted(p)}))
    assert _ended(q)
    got = {r["kafka_offset"]: r["ingested_at"].second for r in t.read().collect()}
    assert t.read().count() == 65 and got == {**{o: 10 + o // 10 for o in range(60)}, **{o: 30 for o in range(60, 65)}, 3: 5}
    # one range a batch however long the history; a replay adds the range of its first copies
    assert touched == {**{k: [f"t-0-{k}"] for k in range(6)}, 6: ["t-0-2", "t-0-6"], 7: ["t-0-0"]}


def test_rate_counts_late_rows(spark, tmp_path):
    folder = str(tmp_path / "f")
    rows = bronze_api(spark, SF_SMALL)
    newest = rows.agg(F.max("kafka_ts")).first()[0]
    split = F.lit(str(newest)).cast("timestamp_ntz") - F.expr("INTERVAL 5 DAYS")
    put(rows.filter(F.col("kafka_ts") >= split), folder)
    put(rows.filter(F.col("kafka_ts") < split), folder)  # all of these are days late
    t = RateTable(spark, str(tmp_path / "t"))
    for _ in range(2):  # the second run has nothing to do
        assert _ended(start_exact_rate(files(spark, folder), t, "kafka_ts", str(tmp_path / "ck"), "rate", trigger=NOW))
    want = reports.events_per_minute(rows, "kafka_ts")
    assert sorted(map(tuple, t.rate().collect())) == sorted(map(tuple, want.collect()))
    late = t.accounted().agg(F.sum("events"), F.sum("late_events")).first()
    assert tuple(late) == (rows.count(), rows.filter(F.col("kafka_ts") < split).count())


def test_rate_replay_gives_the_same_contribution(spark, tmp_path):
    t = RateTable(spark, str(tmp_path / "t"))
    from strata.streaming.rates import counted

    batch = bronze_rows(spark, "t", ["a", "b"], [1, 2])
    for _ in range(2):
        t.add(counted(batch, "kafka_ts", "minute"), "run", 0)
        t.set_newest("run", 0, ts(2))
    assert t.rate().first()["events"] == 2 and t.newest_before("run", 0) is None and t.newest_before("run", 1) == str(ts(2))
    t.set_newest("run", 1, ts(1))
    assert t.newest_before("run", 2) == str(ts(2)) and t.newest_before("run", 1) == str(ts(2))
    t.set_newest("run", 1, ts(1))  # again
    assert t.newest_before("run", 2) == str(ts(2))


def test_progress_log(spark, tmp_path):
    folder, name = str(tmp_path / "f"), f"log_{uuid.uuid4().hex[:6]}"
    for k in range(3):
        put(messages(spark, range(4 * k, 4 * k + 4)), folder)
    log, t = ProgressLog().attach(spark), LandedTable(spark, str(tmp_path / "t"))
    try:
        q = start_landing(files(spark, folder), t, str(tmp_path / "ck"), name, NOW, failing_at(1))
        assert not _ended(q)
        _await(lambda: str(q.runId) in log.ended)
        assert "after the write of batch 1" in log.failures[name] or name in log.failures
        q = start_landing(files(spark, folder), t, str(tmp_path / "ck"), name, NOW)
        assert _ended(q)
        _await(lambda: str(q.runId) in log.ended)
    finally:
        log.detach(spark)
    mine = [r for r in log.frame(spark).collect() if r["name"] == name]
    assert sorted(r["batch"] for r in mine) == [0, 1, 2] and sum(r["rows"] for r in mine) == 12
    assert [tuple(r) for r in log.lag(spark).filter(F.col("name") == name).collect()] == [(name, 2, 12, None)]


def test_lag_from_kafka_offsets():
    assert partition_lag('{"t":{"0":5,"1":7}}', '{"t":{"0":9,"1":7,"2":3}}') == 7
    assert partition_lag('{"logOffset":1}', None) is None and partition_lag('{"logOffset":1}', '{"logOffset":2}') is None
