"""The documented SQL surface over the layers, as DataFrame functions
(B6, B11, B12, C2, C3, C6, D7-D15, F1-F5, G1, K7, K8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.jsonpath import json_path
from strata.functions.time import millis_since_epoch, truncate
from strata.operators.rollup import (
    frequency,
    labelled_counts,
    match_rate,
    rate_per_bucket,
    share_by,
    side_by_side_counts,
    spread_by,
)


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_k(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """ORDER BY ... LIMIT k (F2, F3): a per-partition top-k then one merge
    of k rows per partition, never a full sort."""
    return df.orderBy(*_order(order)).limit(k)


def sorted_by(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Full ORDER BY (F1, F4); for presentation only."""
    return df.orderBy(*_order(order))


def any_rows(df: DataFrame, k: int) -> DataFrame:
    """Bare LIMIT (F5): any k rows."""
    return df.limit(k)


def with_db_flag(enriched: DataFrame) -> DataFrame:
    """``db_id IS NOT NULL AS has_db_record``."""
    return enriched.select("username", "email", "department",
                           F.col("db_id").isNotNull().alias("has_db_record"))


def unmatched_users(api: DataFrame, cdc: DataFrame) -> DataFrame:
    """API users without a source record (C2, B11) as an anti join."""
    return api.alias("a").join(
        cdc.alias("c"), F.lower(F.col("a.email")) == F.lower(F.col("c.email")), "left_anti"
    ).select("username", "email", "full_name", "ingested_at")


def matched_users(enriched: DataFrame) -> DataFrame:
    """Enriched rows with a source record."""
    return enriched.filter(F.col("db_id").isNotNull()).select(
        "username", "email", "department", "last_db_update"
    )


def op_frequency(cdc_bronze: DataFrame) -> DataFrame:
    """Change events per operation, straight from Bronze payloads."""
    return frequency(cdc_bronze.select(json_path("payload", "$.op").alias("op")), "op", "events")


def events_per_minute(bronze: DataFrame, ts: str = "ingested_at") -> DataFrame:
    """Landed messages per minute."""
    return rate_per_bucket(bronze, ts, "minute", "events")


def gender_spread(api: DataFrame) -> DataFrame:
    """Users and oldest/newest birth year per gender."""
    return spread_by(api, "gender", "birth_year").select(
        "gender", "total", F.col("min_birth_year").alias("oldest_birth_year"),
        F.col("max_birth_year").alias("newest_birth_year"),
    )


def department_totals(stats: DataFrame) -> DataFrame:
    """SUM(total_users) per department."""
    return stats.groupBy("department").agg(F.sum("total_users").alias("users"))


def department_match_pct(stats: DataFrame) -> DataFrame:
    """Share of matched users per department, rounded."""
    return share_by(stats, "department", "matched_db_users", "total_users", "match_pct").select(
        "department", F.col("sum_total_users").alias("users"),
        F.col("sum_matched_db_users").alias("matched"), "match_pct",
    )


def overall_match_rate(enriched: DataFrame) -> DataFrame:
    """total, matched, match_pct over all enriched users."""
    return match_rate(enriched, "db_id")


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Labelled row counts per layer, UNION ALL (G1, M3)."""
    return labelled_counts(layers, "layer", "records")


def counts_side_by_side(layers: dict[str, DataFrame]) -> DataFrame:
    """One row with one count column per input."""
    return side_by_side_counts(layers)


def partition_progress(bronze: DataFrame) -> DataFrame:
    """Per topic/partition: messages landed and newest offset (K7)."""
    return bronze.groupBy("kafka_topic", "kafka_partition").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min("kafka_offset").alias("first_offset"),
        F.max("kafka_offset").alias("last_offset"),
    )


def ingest_delay(bronze: DataFrame, unit: str = "hour") -> DataFrame:
    """Landing delay (ingested_at - kafka_ts) in ms per time bucket (K8)."""
    delay = millis_since_epoch("ingested_at") - millis_since_epoch("kafka_ts")
    return bronze.groupBy(truncate(unit, "ingested_at").alias(unit)).agg(
        F.count(F.lit(1)).alias("messages"),
        F.min(delay).alias("min_delay_ms"),
        F.max(delay).alias("max_delay_ms"),
        F.sum(delay).alias("sum_delay_ms"),
    )


def ingest_delay_quantiles(bronze: DataFrame, unit: str = "hour", quantiles=(0.5, 0.95, 0.99),
                           accuracy: int = 10000) -> DataFrame:
    """Landing-delay percentiles (ms) per time bucket (K8).

    ``percentile_approx`` keeps a bounded sketch per group (relative rank
    error ``1 / accuracy``) and merges sketches map-side, so a bucket holding
    a third of all messages costs no more memory than any other.
    """
    delay = millis_since_epoch("ingested_at") - millis_since_epoch("kafka_ts")
    q = F.percentile_approx(delay, list(quantiles), accuracy)
    grouped = bronze.groupBy(truncate(unit, "ingested_at").alias(unit)).agg(
        F.count(F.lit(1)).alias("messages"), q.alias("_q"))
    names = [f"p{round(p * 100):d}_delay_ms" for p in quantiles]
    return grouped.select(unit, "messages", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
