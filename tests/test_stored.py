"""Keyed and landing-day tables: what they read, what they replace, and repeated or late writes."""

import pytest
from helpers import bronze_rows, ts
from pyspark.sql import functions as F

from strata.operators.upsert import DuplicateSourceKeys
from strata.sources.keyed import KeyedTable, buckets_for, offset_ranges
from strata.sources.landing import LandedTable, consume


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def frame(spark, pairs, schema="id long, v string, at int"):
    return spark.createDataFrame(pairs, schema)


def newest():
    return [F.col("at").desc_nulls_last()]


def test_guarded_upsert_is_independent_of_order_and_repetition(spark, tmp_path):
    changes = [[(i, f"a{i}", 1) for i in range(20)], [(i, f"b{i}", 3) for i in range(0, 20, 3)], [(i, f"c{i}", 2) for i in range(0, 25, 2)]]
    want = None
    for k, order in enumerate(((0, 1, 2), (2, 1, 0), (1, 1, 0, 2, 0))):
        t = KeyedTable(spark, str(tmp_path / f"t{k}"), ["id"], buckets=5)
        for i in order:
            t.upsert(frame(spark, changes[i]), newest())
        want = want or rows(t.read())
        assert rows(t.read()) == want and len(want) == 23
    assert t.upsert(frame(spark, []), newest()) == []


def test_upsert_reads_and_replaces_the_places_of_its_rows_only(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["id"], buckets=8)
    t.overwrite(frame(spark, [(i, "a", 1) for i in range(100)]))
    files = lambda: {r[0] for r in t._scan().select(F.input_file_name()).distinct().collect()}
    before = files()
    places = t.upsert(frame(spark, [(7, "b", 2)]))
    assert len(places) == 1 and len(before - files()) == 1 and len(before & files()) == len(before) - 1
    p = plan(t.read_places(places))
    assert "PartitionFilters: [isnotnull(_place" in p or "PartitionFilters: [(_place" in p or "PartitionFilters: [_place" in p
    assert t.read().filter("id = 7").first()["v"] == "b" and t.read().count() == 100


def test_plain_merge_repeated_keys_new_columns_and_types(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["id"], buckets=3)
    t.upsert(frame(spark, [(1, "a", 1), (2, "b", 1)]))
    with pytest.raises(Exception, match="duplicate source key"):
        t.upsert(frame(spark, [(1, "x", 1), (1, "y", 1)]))
    assert issubclass(DuplicateSourceKeys, ValueError) and t.read().count() == 2  # a failed run changes nothing
    # an int key meets the stored long; a new column is null in older rows of the places touched
    t.upsert(spark.createDataFrame([(1, "c", 2, "new")], "id int, v string, at int, w string"))
    assert rows(t._scan().filter("id = 1").select("id", "v", "w")) == ["(1, 'c', 'new')"]


def test_delete_empties_a_place(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["id"], buckets=4)
    assert t.delete(frame(spark, [(1, "", 0)])) == []
    t.overwrite(frame(spark, [(i, "a", 1) for i in range(8)]))
    ids = [r["id"] for r in t._scan().filter(F.col("_place") == t._scan().first()["_place"]).collect()]
    gone = ids + [99]
    t.delete(frame(spark, [(i, "", 0) for i in gone]))
    assert sorted(r["id"] for r in t.read().collect()) == sorted(set(range(8)) - set(ids))
    t.delete(frame(spark, [(i, "", 0) for i in range(8)]))
    assert not t.exists()


def test_upsert_columns_and_insert_if_absent(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["v"], buckets=4)
    t.overwrite(frame(spark, [(1, "a", 1), (2, "b", 1)]))
    t.upsert_columns(frame(spark, [(8, "a", 5), (9, "z", 5)]), ["at"])
    assert rows(t.read().select("id", "v", "at")) == ["(1, 'a', 5)", "(2, 'b', 1)", "(9, 'z', 5)"]
    t.insert_if_absent(frame(spark, [(3, "b", 7), (4, "y", 8), (5, "y", 6)]), ["at"])
    assert rows(t.read().select("id", "v", "at")) == ["(1, 'a', 5)", "(2, 'b', 1)", "(5, 'y', 6)", "(9, 'z', 5)"]


def test_buckets_follow_the_size():
    assert buckets_for(0) == 1 and buckets_for(100 << 40, 512 << 20) == 204800


def test_places_of_messages(spark):
    df = spark.createDataFrame([("t", 0, 9), ("t", 0, 10), ("t", 1, 9), (None, 0, None)], "kafka_topic string, kafka_partition int, kafka_offset long")
    assert [r[0] for r in df.select(offset_ranges(10)).collect()] == ["t-0-0", "t-0-1", "t-1-0", "-0-"]


# --------------------------------------------------------------- landing day
def landed(spark, path):
    t = LandedTable(spark, str(path))
    day = lambda n, at: bronze_rows(spark, "t", [str(n)], [n]).withColumn("ingested_at", F.lit(at).cast("timestamp_ntz"))
    t.land(day(1, "2026-01-01 10:00:00").unionByName(day(2, "2026-01-02 10:00:00")), "run", 0)
    t.land(day(3, "2026-01-05 10:00:00"), "run", 1)
    t.land(day(4, "2026-01-01 23:00:00").unionByName(day(5, "2026-01-06 00:00:00")), "run", 2)  # one lands late
    return t, day


def ids(df):
    return sorted(int(r["payload"]) for r in df.select("payload").collect())


def test_window_reads_the_days_folders(spark, tmp_path):
    t, _ = landed(spark, tmp_path / "b")
    assert ids(t.window("2026-01-02 00:00:00")) == [2, 3, 5]
    assert ids(t.window("2026-01-01 12:00:00", "2026-01-05 11:00:00")) == [2, 3, 4]
    p = plan(t.window("2026-01-05 11:00:00"))
    filters = p.split("PartitionFilters: ")[1].split("]")[0]
    assert "landed_on" in filters and "ingested_at" in p.split("PushedFilters: ")[1].split("]")[0]
    assert t.last_landed() == ts(0).replace(day=6)


def test_slices_follow_batches_not_days(spark, tmp_path):
    t, day = landed(spark, tmp_path / "b")
    got, mark = t.since({"run": 1})
    assert ids(got) == [4, 5] and mark == {"run": 2}  # the late row too
    assert "batch" in plan(got).split("PartitionFilters: ")[1].split("]")[0]
    assert t.since(mark) == (None, mark)
    t.land(day(5, "2026-01-06 00:00:00").unionByName(day(4, "2026-01-01 23:00:00")), "run", 2)  # a replay
    assert ids(t.read()) == [1, 2, 3, 4, 5]
    t.land(day(6, "2026-01-01 00:00:00"), "other", 0)  # another checkpoint starts at 0 again
    got, mark = t.since(mark)
    assert ids(got) == [6] and mark == {"run": 2, "other": 0} and ids(t.read()) == [1, 2, 3, 4, 5, 6]
    t.land(bronze_rows(spark, "t", ["7"], [1]).withColumn("ingested_at", F.lit(None).cast("timestamp_ntz")), "run", 3)
    assert ids(t.since(mark)[0]) == [7]


def test_consumer_that_stops_before_its_mark(spark, tmp_path):
    t, _ = landed(spark, tmp_path / "b")
    target = KeyedTable(spark, str(tmp_path / "s"), ["payload"], buckets=2)
    build = lambda b: b.select("payload", "kafka_offset", "ingested_at")
    order = [F.col("ingested_at").desc_nulls_last()]
    consume(t, target, build, order, "c")
    marks = t.mark_of("c")
    t._fs.delete(f"{t.path}/_marks/c.json")  # published, but the mark was lost
    consume(t, target, build, order, "c")
    assert ids(target.read()) == [1, 2, 3, 4, 5] and t.mark_of("c") == marks == {"run": 2}
    assert consume(t, target, build, order, "c") == []
    assert LandedTable(spark, str(tmp_path / "none")).since(None) == (None, {})
