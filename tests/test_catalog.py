"""Catalog-side DDL helpers on the built-in session catalog."""

import uuid

import pytest

from strata.schemas import BRONZE_SCHEMA
from strata.sources import catalog
from strata.sources.tables import table_exists


def test_create_probe_drop(spark, tmp_path):
    ns = f"ns_{uuid.uuid4().hex[:6]}"
    catalog.create_namespace(spark, ns, str(tmp_path / "ns"))
    catalog.create_namespace(spark, ns)  # idempotent
    name = f"{ns}.api_users_raw"
    assert not table_exists(spark, name)
    catalog.create(spark, name, BRONZE_SCHEMA, location=str(tmp_path / "t"))
    catalog.create(spark, name, BRONZE_SCHEMA, location=str(tmp_path / "t"))  # IF NOT EXISTS
    assert table_exists(spark, name)
    assert [f.name for f in spark.table(name).schema.fields] == [f.name for f in BRONZE_SCHEMA.fields]
    catalog.drop(spark, name)
    catalog.drop(spark, name)
    assert not table_exists(spark, name)


def test_versioned_table_probe(spark, tmp_path):
    assert not table_exists(spark, str(tmp_path / "nothing"))


def test_partitions_whole_and_append(spark, tmp_path):
    ns = f"ns_{uuid.uuid4().hex[:6]}"
    name = f"{ns}.t"
    df = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(6)], "v long, p string")
    try:
        catalog.create(spark, name, df.schema, location=str(tmp_path / "t"), partition_by=("p",))
        catalog.append(df.select("p", "v"), name)  # by name
        catalog.append(df.limit(0), name)
        read = lambda: sorted(tuple(r) for r in spark.table(name).select("v", "p").collect())
        assert read() == sorted((i, "ab"[i % 2]) for i in range(6))
        catalog.replace_partitions(spark.createDataFrame([(9, "a")], "v long, p string"), name)
        assert read() == [(1, "b"), (3, "b"), (5, "b"), (9, "a")]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
        catalog.replace(spark.table(name).filter("v < 4"), name)  # from itself
        assert read() == [(1, "b"), (3, "b")]
        assert [tuple(r) for r in catalog.describe(spark, name).orderBy("position").collect()] == [(0, "v", "bigint", False), (1, "p", "string", True)]
        assert [tuple(r) for r in catalog.tables(spark, ns).collect()] == [("t", False)]
    finally:
        catalog.drop_namespace(spark, ns)
    assert not catalog.exists(spark, name)


def test_mark_of_a_catalog_table(spark, tmp_path):
    from strata.operators.incremental import table_mark

    ns = f"ns_{uuid.uuid4().hex[:6]}"
    try:
        assert table_mark(spark, f"{ns}.t", "v") is None  # absent
        df = spark.createDataFrame([(1,), (7,)], "v long")
        catalog.create(spark, f"{ns}.t", df.schema, location=str(tmp_path / "t"), properties={"made_by": "tests"})
        assert table_mark(spark, f"{ns}.t", "v") is None  # empty
        catalog.append(df, f"{ns}.t")
        assert table_mark(spark, f"{ns}.t", "v") == 7
        assert ("made_by", "tests") in {tuple(r) for r in spark.sql(f"SHOW TBLPROPERTIES {ns}.t").collect()}
        # the statement is understood; Parquet tables of the session catalog have no MERGE
        with pytest.raises(Exception, match="MERGE INTO TABLE"):
            catalog.merge(df, f"{ns}.t", ["v"], delete_when="s.v > 5")
    finally:
        catalog.drop_namespace(spark, ns)


def test_kafka_needs_its_connector(spark):
    from strata.sources import read_kafka, write_kafka

    for use in (lambda: read_kafka(spark, ["a", "b"], "localhost:1", maxOffsetsPerTrigger="10"),
                lambda: write_kafka(spark.range(1), "a", "localhost:1", key="id")):
        with pytest.raises(Exception, match="(?i)kafka"):
            use()
