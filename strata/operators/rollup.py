"""Aggregations behind the documented reports.

All are built-in aggregates, planned partial (map side) then final, so a
group holding a third of the rows is pre-combined on every map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.time import truncate


def count_rows(df: DataFrame, alias: str = "total") -> DataFrame:
    """Global COUNT(*)."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def frequency(df: DataFrame, col: str | Column, alias: str = "n") -> DataFrame:
    """COUNT(*) per category."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(alias))


def rate_per_bucket(df: DataFrame, ts: str, unit: str = "minute", alias: str = "events") -> DataFrame:
    """COUNT(*) per DATE_TRUNC(unit, ts)."""
    return (
        df.groupBy(truncate(unit, ts).alias(unit))
        .agg(F.count(F.lit(1)).alias(alias))
    )


def pct(numer: Column, denom: Column, digits: int = 1) -> Column:
    """ROUND(100 * a / b, digits) in double precision."""
    return F.round(F.lit(100.0) * numer.cast("double") / denom.cast("double"), digits)


def match_rate(df: DataFrame, matched_col: str) -> DataFrame:
    """total, matched, match_pct over the whole input."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(matched_col).alias("matched"),
        pct(F.count(matched_col), F.count(F.lit(1))).alias("match_pct"),
    )


def share_by(df: DataFrame, group: str, part: str, whole: str, alias: str = "match_pct") -> DataFrame:
    """SUM(part), SUM(whole) and their rounded percentage per group."""
    return df.groupBy(group).agg(
        F.sum(whole).alias(f"sum_{whole}"),
        F.sum(part).alias(f"sum_{part}"),
        pct(F.sum(part), F.sum(whole)).alias(alias),
    )


def spread_by(df: DataFrame, group: str, value: str) -> DataFrame:
    """COUNT, MIN, MAX of a value per group."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("total"),
        F.min(value).alias(f"min_{value}"),
        F.max(value).alias(f"max_{value}"),
    )


def labelled_counts(frames: dict[str, DataFrame], label: str = "layer", alias: str = "records") -> DataFrame:
    """UNION ALL of ``SELECT 'name' AS layer, COUNT(*)`` per input (G1, M3)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias(alias)).select(F.lit(name).alias(label), alias)
        for name, df in frames.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def side_by_side_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """``SELECT (SELECT COUNT(*) ...) a, (SELECT COUNT(*) ...) b`` (C6): one
    row with one count column per input, from a single aggregate over the
    tagged inputs (each input is scanned once, only its tag is kept)."""
    tagged = None
    for name, df in frames.items():
        t = df.select(F.lit(name).alias("_src"))
        tagged = t if tagged is None else tagged.unionByName(t)
    return tagged.agg(
        *[F.count(F.when(F.col("_src") == name, F.lit(1))).alias(name) for name in frames]
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], alias: str = "copies") -> DataFrame:
    """GROUP BY keys HAVING COUNT(*) > 1."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(alias))
        .filter(F.col(alias) > 1)
    )
