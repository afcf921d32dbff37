"""FX6: versions, time travel, compaction, expiry, commit conflicts."""

from datetime import datetime, timedelta, timezone

import pytest
from helpers import bronze_rows
from fixtures import FX1

from strata.plans.maintenance import maintain
from strata.sources.tables import CommitConflict, VersionedTable


def fx1(spark):
    return bronze_rows(spark, "users_created", [p for p, _ in FX1], [s for _, s in FX1])


def test_versions_and_time_travel(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "bronze"))
    df = fx1(spark)
    for lo in (0, 3, 6):
        t.append(df.filter(f"kafka_offset >= {lo} AND kafka_offset < {lo + 3}"))
    hist = t.history().orderBy("version").collect()
    assert [h["version"] for h in hist] == [0, 1, 2]
    assert [h["summary"]["records"] for h in hist] == ["3", "3", "3"]
    assert t.read(version=0).count() == 3
    assert t.read(version=1).count() == 6
    assert t.read().count() == 9
    assert t.read(as_of=hist[1]["committed_at"]).count() == 6
    with pytest.raises(ValueError):
        t.read(as_of=datetime(2000, 1, 1))


def test_compaction_keeps_rows_and_reduces_files(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "small"))
    df = fx1(spark)
    for i in range(9):
        t.append(df.filter(f"kafka_offset = {i}").repartition(1))
    before = len(t.file_sizes())
    rows = sorted(tuple(r) for r in t.read().collect())
    report = t.compact(min_input_files=5)
    assert report["status"] == "compacted"
    assert len(t.file_sizes()) < before
    assert sorted(tuple(r) for r in t.read().collect()) == rows
    assert t.latest().operation == "compact"
    skipped = t.compact(min_input_files=5)  # one file now: below the minimum
    assert skipped["status"] == "skipped"


def test_expiry_keeps_last_versions(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "expire"))
    df = fx1(spark)
    for lo in (0, 3, 6):
        t.append(df.filter(f"kafka_offset >= {lo} AND kafka_offset < {lo + 3}"))
    out = t.expire(datetime.now(timezone.utc).replace(tzinfo=None) + timedelta(days=1), retain_last=2)
    assert out["expired_versions"] == 1
    assert sorted(r["version"] for r in t.history().collect()) == [1, 2]
    assert t.read().count() == 9  # data still referenced by retained versions stays


def test_expiry_respects_age(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "young"))
    t.append(fx1(spark))
    t.append(fx1(spark))
    out = t.expire(datetime.now(timezone.utc).replace(tzinfo=None) - timedelta(days=7), retain_last=1)
    assert out["expired_versions"] == 0


def test_commit_conflict(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "race"))
    t.append(fx1(spark))
    seen = t.latest()
    VersionedTable(spark, str(tmp_path / "race")).append(fx1(spark))
    with pytest.raises(CommitConflict):
        t._commit("append", [], fx1(spark).schema, base=seen)


def interleave(table, action):
    """Run ``action`` once, inside the table's next write."""
    whole, done = table._next_data_dir, []

    def hook():
        if not done:
            done.append(1)
            action()
        return whole()

    table._next_data_dir = hook


def test_append_during_compaction_is_kept(spark, tmp_path):
    root = str(tmp_path / "busy")
    rows = spark.range(70)
    t = VersionedTable(spark, root)
    for k in range(6):
        t.append(rows.filter(f"id >= {10 * k} AND id < {10 * k + 10}"))
    interleave(t, lambda: VersionedTable(spark, root).append(rows.filter("id >= 60")))
    assert t.compact(min_input_files=1)["status"] == "compacted"
    assert sorted(r[0] for r in t.read().collect()) == list(range(70))


def test_append_during_append_is_kept(spark, tmp_path):
    root = str(tmp_path / "two")
    t = VersionedTable(spark, root)
    t.append(spark.range(10))
    interleave(t, lambda: VersionedTable(spark, root).append(spark.range(10, 20)))
    t.append(spark.range(20, 30))
    assert sorted(r[0] for r in t.read().collect()) == list(range(30))


def test_overlapping_merges_keep_all_rows(spark, tmp_path):
    root = str(tmp_path / "merges")
    rows = spark.range(30).selectExpr("id AS k", "0 AS v")
    t = VersionedTable(spark, root, buckets=4, bucket_keys=["k"])
    t.merge(rows.filter("k < 10"), ["k"])
    interleave(t, lambda: VersionedTable(spark, root).merge(rows.filter("k >= 20"), ["k"]))
    t.merge(rows.filter("k >= 10 AND k < 20"), ["k"])
    assert sorted(r["k"] for r in t.read().collect()) == list(range(30))


def test_duplicate_source_keys_raise(spark, tmp_path):
    from strata.operators.upsert import DuplicateSourceKeys, upsert_columns

    t = VersionedTable(spark, str(tmp_path / "dup"), buckets=2, bucket_keys=["k"])
    two = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(DuplicateSourceKeys):
        t.merge(two, ["k"])
    assert t.latest() is None
    with pytest.raises(Exception, match="duplicate source key"):
        upsert_columns(two.limit(0), two, ["k"], ["v"]).collect()


def test_new_columns_are_stored(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "B", "x"), (3, "c", "y")], "k long, v string, extra string")
    t = VersionedTable(spark, str(tmp_path / "merged"), buckets=4, bucket_keys=["k"])
    t.merge(old, ["k"])
    t.merge(new, ["k"])
    assert sorted(map(tuple, t.read().collect())) == [(1, "a", None), (2, "B", "x"), (3, "c", "y")]
    a = VersionedTable(spark, str(tmp_path / "appended"))
    a.append(old)
    a.append(new)
    assert sorted(map(tuple, a.read().collect())) == [
        (1, "a", None), (2, "B", "x"), (2, "b", None), (3, "c", "y")]


def test_bucketed_merge_rewrites_only_touched_buckets(spark, tmp_path):
    from strata.operators.upsert import upsert

    t = VersionedTable(spark, str(tmp_path / "buckets"), buckets=16, bucket_keys=["k"])
    base = spark.range(0, 1000).selectExpr("id AS k", "'v0' AS v")
    t.merge(base, ["k"])
    assert t.latest().summary["touched_buckets"] == "16"
    assert len(t.file_sizes()) == 16  # one file per bucket, written by one shuffle
    upd = spark.createDataFrame([(5, "v1"), (2000, "new")], "k long, v string")
    t.merge(upd, ["k"])
    assert int(t.latest().summary["touched_buckets"]) <= 2
    got = {r["k"]: r["v"] for r in t.read().collect()}
    assert len(got) == 1001 and got[5] == "v1" and got[2000] == "new" and got[6] == "v0"
    assert t.read(version=0).count() == 1000
    # a custom row algebra still plugs in
    t.merge(spark.createDataFrame([(6, "v2")], "k long, v string"), combine=lambda a, b: upsert(a, b, ["k"]))
    assert {r["k"]: r["v"] for r in t.read().collect()}[6] == "v2"


def test_maintain_report(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "m1"))
    for i in range(6):
        t.append(fx1(spark).filter(f"kafka_offset = {i}").repartition(1))
    rep = {r["table"]: r for r in maintain(spark, {"bronze": t.root, "absent": str(tmp_path / "nope")},
                                           retain_last=2).collect()}
    assert rep["bronze"]["status"] == "compacted"
    assert rep["absent"]["status"] == "missing"


def test_bucket_layout_one_slice_per_task(spark, tmp_path):
    from pyspark.sql import functions as F

    t = VersionedTable(spark, str(tmp_path / "layout"), buckets=16, bucket_keys=["k"])
    rows = spark.range(5000).withColumnRenamed("id", "k")
    for touched, files, tasks in ((16, 1, 16), (16, 2, 32), (2, 1, None)):
        keyed, _ = t._cluster(rows.filter(F.col("k") % 8 != 0) if touched == 2 else rows, touched, files)
        per_task = keyed.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count_distinct("sb").alias("buckets"), F.min("sb").alias("sb")).collect()
        if tasks is None:  # few touched buckets: touched x slices partitions, no untouched work
            assert keyed.rdd.getNumPartitions() == 2
            continue
        assert len(per_task) == tasks
        assert all(r["buckets"] == 1 and r["p"] % 16 == r["sb"] for r in per_task)


def test_bucket_layout_is_recorded_as_runs(spark, tmp_path):
    import json

    from pyspark.sql import functions as F

    t = VersionedTable(spark, str(tmp_path / "runs"), buckets=64, bucket_keys=["k"])
    rows = spark.range(20000).withColumnRenamed("id", "k").withColumn("v", F.lit(0))
    t.overwrite(rows)
    change = rows.filter(F.col("k") < 40).withColumn("v", F.lit(1))
    c = t.merge(change, ["k"])
    entry = json.loads(t._fs.read_text(t._entry(c.version)))
    assert entry["parts"] == [] and len(entry["layout"]) == 2
    assert len(t.latest().parts) == 64 and c.summary["change_rows"] == "40"
    assert t.read().filter("v = 1").count() == 40 and t.read().count() == 20000


def test_expiry_keeps_folders_linked_by_bucket_layout(spark, tmp_path):
    from pyspark.sql import functions as F

    t = VersionedTable(spark, str(tmp_path / "bexp"), buckets=16, bucket_keys=["k"])
    rows = spark.range(5000).withColumnRenamed("id", "k").withColumn("v", F.lit(0))
    t.overwrite(rows)
    for step in (1, 2):  # each change touches a few buckets; the rest stay in version 0's folder
        t.merge(rows.filter(F.col("k") < 3 * step).withColumn("v", F.lit(step)), ["k"])
    out = t.expire(datetime.now(timezone.utc).replace(tzinfo=None) + timedelta(days=1), retain_last=1)
    assert out["expired_versions"] == 2
    assert t.read().count() == 5000
    assert sorted(r["v"] for r in t.read().filter("k < 6").collect()) == [2] * 6


def test_bucket_bitmaps_give_exact_ids_across_blocks(spark):
    from pyspark.sql import functions as F

    from strata.sources.tables import bitmap_ids, bucket_bitmaps

    buckets = 70000  # three bitmap blocks
    ids = spark.range(300000).select((F.col("id") * 7919 % buckets).cast("int").alias("b")).filter("b % 5 != 0")
    row = ids.agg(*bucket_bitmaps(F.col("b"), buckets)).first()
    got = bitmap_ids([row[f"_bm{k}"] for k in range(3)])
    assert got == sorted(r[0] for r in ids.distinct().collect())


def test_hot_bucket_key_is_split_over_slices(spark, tmp_path):
    from pyspark.sql import functions as F

    # bucket key `g` is only part of the row key (g, k); g = 0 holds a third of the rows
    t = VersionedTable(spark, str(tmp_path / "hot"), buckets=8, bucket_keys=["g"])
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("g"),
        F.col("id").alias("k"), F.lit(0).alias("v"))
    keyed, _ = t._cluster(rows, 8, 4, ["g", "k"])
    hot = keyed.filter("g = 0").groupBy(F.spark_partition_id()).count().collect()
    assert len(hot) == 4 and sum(r["count"] for r in hot) == 1000
    t.overwrite(rows)
    t.merge(rows.filter("g = 0").withColumn("v", F.lit(1)), ["g", "k"], files_per_bucket=4)
    assert t.read().filter("v = 1").count() == 1000 and t.read().count() == 3000


def test_partition_inspection_counts_every_row(spark, tmp_path):
    from pyspark.sql import functions as F

    t = VersionedTable(spark, str(tmp_path / "parts"), buckets=8, bucket_keys=["k"])
    rows = spark.range(4000).withColumnRenamed("id", "k")
    t.overwrite(rows, files_per_bucket=2)
    p = t.partitions().collect()
    assert sorted(r["bucket"] for r in p) == list(range(8))
    assert sum(r["record_count"] for r in p) == 4000 and all(r["file_count"] == 2 for r in p)
    expected = {r["sb"]: r["count"] for r in rows.groupBy(
        F.pmod(F.hash("k"), F.lit(8)).alias("sb")).count().collect()}
    assert {r["bucket"]: r["record_count"] for r in p} == expected
    plain = VersionedTable(spark, str(tmp_path / "plain"))
    plain.append(rows)
    one = plain.partitions().collect()
    assert len(one) == 1 and one[0]["bucket"] is None and one[0]["record_count"] == 4000


def test_bucketed_compaction_rewrites_only_fragmented_buckets(spark, tmp_path):
    from pyspark.sql import functions as F

    t = VersionedTable(spark, str(tmp_path / "bc"), buckets=8, bucket_keys=["k"])
    rows = spark.range(4000).withColumnRenamed("id", "k").withColumn("v", F.lit(0))
    t.overwrite(rows)  # one file per bucket: healthy
    assert t.compact(min_input_files=5)["status"] == "skipped"
    # two buckets get split into 4 small files each by a change written with 4 slices
    hot = rows.filter(F.pmod(F.hash("k"), F.lit(8)) < 2).withColumn("v", F.lit(1))
    t.merge(hot, ["k"], files_per_bucket=4)
    before = {r["bucket"]: r["file_count"] for r in t.partitions().collect()}
    assert before[0] == 4 and before[1] == 4 and before[5] == 1
    untouched = t.latest().parts[5]
    report = t.compact(min_input_files=5)
    assert report["status"] == "compacted" and report["rewritten_files"] == 8
    after = {r["bucket"]: r["file_count"] for r in t.partitions().collect()}
    assert set(after.values()) == {1} and t.latest().parts[5] == untouched
    assert t.read().count() == 4000 and t.read().filter("v = 1").count() == hot.count()


def test_append_compaction_keeps_large_folders(spark, tmp_path):
    from pyspark.sql import functions as F

    t = VersionedTable(spark, str(tmp_path / "ac"))
    rows = spark.range(20000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    t.append(rows.coalesce(1))  # one large file
    big = t.latest().parts[0]
    for i in range(3):  # three commits of small files
        t.append(spark.range(100 * i, 100 * i + 100).select(
            F.col("id"), F.lit("x").alias("pad")).repartition(3))
    big_bytes = t.size_summary()[1]  # upper bound on the large file's size
    report = t.compact(target_file_bytes=big_bytes, min_input_files=5)
    assert report["status"] == "compacted" and report["rewritten_files"] == 9
    assert t.latest().parts[0] == big and len(t.latest().parts) == 2
    assert t.read().count() == 20300


from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 5000), st.sampled_from(["data/a", "data/b", "data/c-1"]), max_size=300))
def test_layout_runs_round_trip(assign):
    from strata.sources.tables import decode_layout, encode_layout

    parts = [f"{folder}/sb={b}" for b, folder in assign.items()]
    assert decode_layout(encode_layout(parts)) == [p for _, p in sorted((b, p) for b, p in
                                                                        zip(assign, parts))]


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 70000), max_size=200))
def test_bitmap_ids_inverse(ids):
    from strata.sources.tables import BITMAP_BITS, bitmap_ids

    blocks = [bytearray(BITMAP_BITS // 8) for _ in range(3)]
    for i in ids:
        k, pos = divmod(i, BITMAP_BITS)
        blocks[k][pos // 8] |= 1 << (pos % 8)
    assert bitmap_ids([bytes(b) for b in blocks]) == sorted(ids)


def test_as_of_read_does_not_depend_on_session_zone(spark, tmp_path):
    from strata.operators.incremental import incremental_slice

    t = VersionedTable(spark, str(tmp_path / "tz"))
    t.append(spark.range(10).selectExpr("id", "TIMESTAMP_NTZ '2026-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id) AS ts"))
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert t.read(as_of=now).count() == 10
        assert incremental_slice(t.read(), "ts", datetime(2026, 1, 1, 0, 0, 6)).count() == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_merge_leaves_no_staging_behind(spark, tmp_path):
    import os

    from pyspark.sql import functions as F

    from strata.session import checkpoint_root

    t = VersionedTable(spark, str(tmp_path / "stg"), buckets=4, bucket_keys=["k"])
    rows = spark.range(100).withColumnRenamed("id", "k").withColumn("v", F.lit(0))
    t.overwrite(rows)
    scratch = f"{checkpoint_root(spark)}/strata"
    before = {n for n in os.listdir(scratch) if n.startswith("merge-staging")} if os.path.isdir(scratch) else set()
    t.merge(rows.filter("k < 10").withColumn("v", F.lit(1)), ["k"])
    after = {n for n in os.listdir(scratch) if n.startswith("merge-staging")}
    assert after <= before
    assert t.read().filter("v = 1").count() == 10
