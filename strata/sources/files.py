"""File scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json_tree(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   multiline: bool = False) -> DataFrame:
    """Every JSON file under ``path`` at any depth (``**/*.json``), with an
    inferred schema or a declared one (declared is one pass cheaper)."""
    reader = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
        .option("multiLine", str(multiline).lower())
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists",
                     partition_by: list[str] | None = None) -> None:
    """One JSON object per line per row (the producer's serialisation);
    ``partition_by`` lays files out in nested ``col=value`` folders."""
    writer = df.write.mode(mode).option("ignoreNullFields", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def as_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows to Kafka-style (key, value) messages: value is the row's JSON."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)


def write_kafka(df: DataFrame, topic: str, bootstrap: str, key: str | None = None) -> None:
    """Publish rows as JSON messages to a topic (A15; needs the connector)."""
    (
        as_messages(df, key)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("topic", topic)
        .save()
    )
