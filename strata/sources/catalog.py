"""Tables of Spark's catalog (A5-A10, J9): create, write, list, describe, probe, replace, drop.

Works on the built-in session catalog and on any configured one.  Names are ``namespace.table`` (or with a catalog
in front).  Listings come back as rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import materialize


def create_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """Created where it is absent."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{loc}")


def create(spark: SparkSession, name: str, schema: T.StructType, location: str | None = None, using: str = "parquet",
           partition_by: tuple[str, ...] = (), properties: dict[str, str] | None = None) -> None:
    """Declared table, created where it is absent (A5), with its namespace."""
    namespace = name.rpartition(".")[0]
    if namespace:
        create_namespace(spark, namespace)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    props = f" TBLPROPERTIES ({', '.join(f"'{k}' = '{v}'" for k, v in properties.items())})" if properties else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {using}{parts}{loc}{props}")


def exists(spark: SparkSession, name: str) -> bool:
    """False only where the table is absent."""
    return spark.catalog.tableExists(name)


def append(df: DataFrame, name: str) -> None:
    """A4: add rows, matched by column name."""
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name)


def replace(df: DataFrame, name: str) -> None:
    """The rows become the whole table; its declaration stays.  The rows may come from the table itself: they are
    written out first."""
    materialize(df.select(*df.sparkSession.table(name).columns), "catalog-replace").write.insertInto(name, overwrite=True)


def replace_partitions(df: DataFrame, name: str) -> None:
    """Replace the partitions that the rows lie in, and no others."""
    spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # an insert into a table takes it from the session only
    try:
        df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def tables(spark: SparkSession, namespace: str) -> DataFrame:
    """Table names and whether they are temporary."""
    return spark.sql(f"SHOW TABLES IN {namespace}").select(F.col("tableName").alias("table_name"), F.col("isTemporary").alias("is_temporary"))


def describe(spark: SparkSession, name: str) -> DataFrame:
    """Columns in order, with their types; partition columns are named once."""
    fields = spark.table(name).schema.fields
    parts = {c.name for c in spark.catalog.listColumns(name) if c.isPartition}
    return spark.createDataFrame([(i, f.name, f.dataType.simpleString(), f.name in parts) for i, f in enumerate(fields)],
                                 "position int, col_name string, data_type string, is_partition boolean")


def drop(spark: SparkSession, name: str) -> None:
    """A10: also where it is absent."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"DROP NAMESPACE IF EXISTS {namespace} CASCADE")


def merge(df: DataFrame, name: str, keys: list[str], delete_when: str | None = None) -> None:
    """I4: ``MERGE INTO`` by key, on a catalog whose tables support it (the session catalog's Parquet tables don't)."""
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    gone = f"WHEN MATCHED AND {delete_when} THEN DELETE " if delete_when else ""
    df.sparkSession.sql(f"MERGE INTO {name} t USING {{updates}} s ON {on} {gone}"
                        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *", updates=df)
