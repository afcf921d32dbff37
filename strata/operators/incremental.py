"""High-water marks and incremental slices."""

from __future__ import annotations

from datetime import datetime

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.time import ts_literal

FLOOR_TS = "1970-01-01 00:00:00"


def max_of(df: DataFrame, column: str, alias: str = "max_ts") -> DataFrame:
    """Global MAX as a one-row DataFrame."""
    return df.agg(F.max(column).alias(alias))


def high_water_mark(df: DataFrame, column: str) -> Any:
    """MAX(column) as a driver value (one scalar), or None on an empty input."""
    return max_of(df, column).first()[0]


def table_mark(spark: SparkSession, table: str, column: str = "ingested_at") -> Any:
    """Mark of a catalog table; None only when the table does not exist."""
    if not spark.catalog.tableExists(table):
        return None
    return high_water_mark(spark.table(table), column)


def incremental_slice(df: DataFrame, column: str, mark: Any, overlap: str | None = None) -> DataFrame:
    """Rows strictly after ``mark`` (I2); a literal bound reaches the Parquet
    scan as a pushed filter.  ``overlap`` re-reads a safety margin for late
    commits; pair it with an idempotent (guarded) merge."""
    if mark is None:
        return df
    dtype = df.schema[column].dataType
    if isinstance(mark, (str, datetime)):
        bound = ts_literal(mark, dtype)
    else:
        bound = F.lit(mark)
    if overlap:
        bound = bound - F.expr(f"INTERVAL {overlap}")
    return df.filter(F.col(column) > bound)


def slice_after_target(df: DataFrame, column: str, target: DataFrame, target_column: str | None = None,
                       floor: str = FLOOR_TS) -> DataFrame:
    """``WHERE col > (SELECT COALESCE(MAX(t.col), floor) FROM target)`` (C5),
    planned as an uncorrelated scalar subquery, run once."""
    tcol = target_column or column
    dtype = df.schema[column].dataType
    bound = target.select(F.coalesce(F.max(tcol), F.lit(floor).cast(dtype))).scalar()
    return df.filter(F.col(column) > bound)
