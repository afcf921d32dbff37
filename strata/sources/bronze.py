"""Raw-feed sources and the Bronze envelope.

Bronze stores each message untouched (``payload``) with its transport
coordinates; parsing happens on read (``typed_view``) or in Silver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.jsonpath import json_first
from strata.functions.time import to_millis_precision
from strata.operators.fence import fenced_select
from strata.schemas import BRONZE_COLUMNS

#: rows whose messages one task makes or parses: some tens of seconds
ROWS_PER_TASK = 250_000


def read_kafka(spark: SparkSession, topics: Sequence[str], bootstrap: str,
               starting_offsets: str = "earliest", **options: str) -> DataFrame:
    """Streaming Kafka source, whole message as bytes (A1, A3).

    Needs the Kafka connector on the classpath.  ``startingOffsets`` applies
    to the first run only; afterwards the checkpoint decides.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting_offsets)
    )
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def to_bronze(kafka_rows: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Kafka-shaped rows (value, topic, partition, offset, timestamp) to the
    Bronze envelope: payload passthrough, millisecond event stamp and the
    landing time (A4).  No filter: deletes and odd messages are kept."""
    landed = ingested_at if ingested_at is not None else to_millis_precision(F.localtimestamp())
    return kafka_rows.select(
        F.col("value").cast("string").alias("payload"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        to_millis_precision(F.col("timestamp").cast("timestamp_ntz")).alias("kafka_ts"),
        landed.alias("ingested_at"),
    )


def split_by_topic(bronze: DataFrame, topics: Sequence[str]) -> dict[str, DataFrame]:
    """One multi-topic stream to one Bronze frame per topic (A2)."""
    return {t: bronze.filter(F.col("kafka_topic") == t) for t in topics}


def typed_view(bronze: DataFrame, fields: dict[str, Sequence[str]],
               keep: Sequence[str] = ("ingested_at",)) -> DataFrame:
    """Typed projection over raw payloads, the query-time Bronze read.
    Each field is extracted once per row, by the same paths as Silver's."""
    return fenced_select(bronze, *[json_first("payload", *paths).alias(name) for name, paths in fields.items()], *keep)


def spread_small_scan(df: DataFrame, min_partitions: int | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Spread a scan whose rows lie in too few of its splits.

    A row group (or a gzip file) is read by one task however many splits its
    bytes are cut into, and all per-row work before the first shuffle would run
    there.  The rows of every split are counted first: a scan of no columns, from the
    files' footers, two numbers to the driver.  Where one split has more than
    ``rows_per_task`` rows, or twice its share of the cluster's cores, rows are
    dealt round-robin over enough tasks for both (at least ``min_partitions``, default: the
    cluster's parallelism); an even scan is returned untouched, with no
    shuffle added.
    """
    if df.isStreaming:
        return df
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # no Spark context (a remote session): leave the plan alone
        return df
    splits = df.groupBy(F.spark_partition_id().alias("split")).agg(F.count(F.lit(1)).alias("n"))
    total, most = splits.agg(F.sum("n"), F.max("n")).first()
    if not total or (most <= rows_per_task and most * target <= 2 * total):
        return df
    return df.repartition(max(target, -(-total // rows_per_task)))


def select_bronze(df: DataFrame) -> DataFrame:
    return df.select(*BRONZE_COLUMNS)
