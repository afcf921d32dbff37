"""Message dedup into a bucketed table: what a batch writes follows the batch, and the state is that of the guarded merge."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import ts

from strata.operators.dedup import drop_duplicate_messages
from strata.schemas import BRONZE_SCHEMA, MESSAGE_ID
from strata.sources import tables
from strata.sources.tables import VersionedTable
from strata.streaming.upsert_stream import start_dedup


def messages(spark, offsets, landed, partition=0, topic="t"):
    return spark.createDataFrame([(f"m{o} {landed}", topic, partition, o, ts(1), None if landed is None else ts(landed)) for o in offsets], BRONZE_SCHEMA)


def rows_on_disk(spark, t):
    """Rows in all data files of all versions."""
    return spark.read.option("recursiveFileLookup", "true").schema(BRONZE_SCHEMA).parquet(f"{t.root}/data").count()


def state(t):
    return sorted(map(str, t.read().select(*BRONZE_SCHEMA.names).collect()))


def test_stream_dedup_writes_each_message_once(spark, tmp_path):
    landing = str(tmp_path / "landing")
    for n in range(6):
        messages(spark, range(n * 50, n * 50 + 50), 10 + n).coalesce(1).write.mode("append").parquet(landing)
    messages(spark, range(150, 300), 30).coalesce(1).write.mode("append").parquet(landing)  # a replay
    stream = spark.readStream.schema(BRONZE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(landing)
    t = VersionedTable(spark, str(tmp_path / "bronze"), buckets=4, bucket_keys=MESSAGE_ID)
    start_dedup(stream, t, str(tmp_path / "ck"), "dedup", {"availableNow": True}).awaitTermination()
    assert state(t) == sorted(map(str, drop_duplicate_messages(spark.read.schema(BRONZE_SCHEMA).parquet(landing)).collect()))
    assert rows_on_disk(spark, t) == 300
    assert [r["version"] for r in t.history().orderBy("version").collect()] == list(range(6))  # the replay changed nothing
    assert t.read(version=2).count() == 150


@pytest.mark.parametrize("small", [0, 1_000_000])
def test_earlier_copies_and_null_keys(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(tables, "SMALL_CHANGE", small)
    t, plain = (VersionedTable(spark, str(tmp_path / n), buckets=4, bucket_keys=MESSAGE_ID) for n in ("kept", "merged"))
    rng = random.Random(3)
    order = [F.col("ingested_at").asc_nulls_last()]
    for n in range(5):
        # a second of its own for every message, so that no copies tie
        seconds = rng.sample(range(60), 40)
        rows = [(f"{n} {s}", rng.choice(["t", None]), rng.choice([0, None]), rng.choice([1, 2, 3, 4, 5, None]), ts(1),
                 None if n == 0 and s < 10 else ts(s)) for s in seconds]
        batch = spark.createDataFrame(rows, BRONZE_SCHEMA).withColumn("ingested_at", F.col("ingested_at") + F.make_dt_interval(secs=F.lit(n / 8)))
        t.keep_first(drop_duplicate_messages(batch), "ingested_at", txn=f"q:{n}")
        plain.merge(drop_duplicate_messages(batch), MESSAGE_ID, order)
        assert state(t) == state(plain)
    assert t.read().select(*MESSAGE_ID).distinct().count() == t.read().count() == 24
    assert t.committed_txn("q:0")


def test_only_buckets_of_earlier_copies_are_rewritten(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), buckets=4, bucket_keys=MESSAGE_ID)
    t.keep_first(messages(spark, range(100), 20), "ingested_at")
    t.keep_first(messages(spark, range(100, 200), 21), "ingested_at")
    before = t._bucket_map(t.latest())
    assert {len(f) for f in before.values()} == {2}
    t.keep_first(messages(spark, [7], 5).unionByName(messages(spark, range(200, 260), 22)), "ingested_at")
    after = t._bucket_map(t.latest())
    assert sorted(len(f) for f in after.values()) == [1, 3, 3, 3]
    assert all(after[b][:2] == before[b] for b in after if len(after[b]) == 3)
    assert t.read().count() == 260 and t.read().filter("kafka_offset = 7").first()["ingested_at"].second == 5
    old, new = t.changed_since(1)
    assert old.count() == 200 and new.count() == 260
    t.compact(min_input_files=2)
    assert {len(f) for f in t._bucket_map(t.latest()).values()} == {1} and t.read().count() == 260
    # the plain merge goes on from there
    t.keep_first(messages(spark, [300], 23), "ingested_at")
    t.merge(messages(spark, [300, 301], 24), MESSAGE_ID)
    assert t.read().count() == 262 and t.read().filter("kafka_offset = 300").first()["ingested_at"].second == 24


def test_keep_first_after_another_writer(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    t = VersionedTable(spark, root, buckets=4, bucket_keys=MESSAGE_ID)
    t.keep_first(messages(spark, range(10), 20), "ingested_at")
    inner, once = t._relink, []

    def relink(*a, **b):
        if not once:
            once.append(1)
            VersionedTable(spark, root).keep_first(messages(spark, range(10, 20), 20), "ingested_at")
        return inner(*a, **b)

    monkeypatch.setattr(t, "_relink", relink)
    t.keep_first(messages(spark, range(5, 30), 21), "ingested_at")
    assert t.read().count() == 30 and t.read().filter(F.second("ingested_at") == 20).count() == 20
