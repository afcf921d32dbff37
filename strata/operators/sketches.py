"""Mergeable sketches of a feed (K8, D5): figures over long spans without reading the feed again.

A batch adds, for each minute, how many messages it had, a KLL sketch of their landing delays and a HyperLogLog
sketch of who sent them.  Both have a fixed size and merge without loss of their error bound, so days, months or any other span come
from the minutes' sketches, and batches of one minute simply add up.

Errors: a KLL quantile of ``k`` = 400 lies within 0.9 % of the rank asked for (99 % confidence); HyperLogLog with
2^12 registers has a relative standard error of 1.6 %.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.time import millis_since_epoch, truncate

KLL_K = 400
HLL_LG_K = 12
BATCH = "batch"


def delay_sketches(bronze: DataFrame, who: Column, unit: str = "minute") -> DataFrame:
    """minute, messages, delays (KLL of landing delays in ms), senders (HyperLogLog of ``who``).  Partial aggregation: a task
    sends one sketch per minute it has met."""
    delay = millis_since_epoch("ingested_at") - millis_since_epoch("kafka_ts")
    return bronze.groupBy(truncate(unit, "ingested_at").alias(unit)).agg(
        F.count(F.lit(1)).alias("messages"), F.kll_sketch_agg_bigint(delay, KLL_K).alias("delays"),
        F.hll_sketch_agg(who, HLL_LG_K).alias("senders"))


def merged(sketches: DataFrame, unit: str, of: str = "minute") -> DataFrame:
    """The sketches of a longer unit."""
    return sketches.groupBy(truncate(unit, of).alias(unit)).agg(
        F.sum("messages").alias("messages"), F.kll_merge_agg_bigint("delays", KLL_K).alias("delays"),
        F.hll_union_agg("senders").alias("senders"))


def figures(sketches: DataFrame, unit: str, quantiles=(0.5, 0.95, 0.99)) -> DataFrame:
    """unit, messages, senders (estimate) and the delay quantiles."""
    return sketches.select(
        unit, "messages", F.hll_sketch_estimate("senders").alias("senders"),
        *[F.kll_sketch_get_quantile_bigint("delays", F.lit(q)).alias(f"p{round(q * 100):d}_delay_ms") for q in quantiles])


class SketchTable:
    """Sketches by batch: a batch that is written again replaces itself."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, sketches: DataFrame, batch: str) -> None:
        (sketches.withColumn(BATCH, F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH).parquet(self.path))

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop(BATCH)
