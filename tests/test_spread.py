"""Scans whose splits outnumber their row groups."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.sources.bronze import spread_small_scan

ROWS = 40_000


@pytest.fixture
def one_group(spark, tmp_path):
    """One row group, cut into more splits than there are cores."""
    path = f"{tmp_path}/rows.parquet"
    pq.write_table(pa.table({"id": range(ROWS), "text": [f"row {i * 7919 % ROWS}" for i in range(ROWS)]}), path, row_group_size=ROWS)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    yield spark.read.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def per_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_rows_of_one_group_are_dealt_to_all_cores(spark, one_group):
    target = spark.sparkContext.defaultParallelism
    assert one_group.rdd.getNumPartitions() >= target and len(per_task(one_group)) == 1
    spread = spread_small_scan(one_group)
    assert max(per_task(spread)) <= 2 * ROWS // target
    assert sorted(r["id"] for r in spread.collect()) == list(range(ROWS))


def test_tasks_stay_bounded_as_rows_grow(spark, one_group):
    assert max(per_task(spread_small_scan(one_group, rows_per_task=1000))) <= 1100


def test_even_scans_get_no_shuffle(spark):
    df = spark.range(1000)
    assert spread_small_scan(df) is df
    assert spread_small_scan(df.filter("id < 0")).count() == 0


def test_landing_spans_deal_no_rows(spark, monkeypatch):
    """Cut points need the least and greatest landing time only; slices hold every row once."""
    from strata.plans import queries_state as q

    sf_dir, plans, cut = "/root/testdata/sf0.001", [], q._cut_points
    monkeypatch.setattr(q, "_cut_points", lambda df, shares: plans.append(df._jdf.queryExecution().toString()) or cut(df, shares))
    layout = q._incremental_gold(spark, sf_dir)
    assert len(plans) == 2 and not any("RoundRobin" in p for p in plans)
    for name, feed in (("api", q.bronze_api), ("cdc", q.bronze_cdc)):
        landed = layout.table(spark, f"bronze/{name}_users_raw").read()
        assert landed.exceptAll(feed(spark, sf_dir)).count() == 0 and landed.count() == feed(spark, sf_dir).count()
