"""Latest-state dedup (E1, E2) and message-level dedup (K4).

``latest_per_key`` is ``row_number() OVER (PARTITION BY keys ORDER BY ...) = 1``;
Spark plans it with a partial ``WindowGroupLimit`` before the shuffle, so a
hot key is cut to one row per map task before it crosses the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.schemas import MESSAGE_ID

_RANK = "_strata_rank"


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key under ``order`` (e.g. ``[F.col('ts').desc()]``).

    ``order`` should be a total order within a key (add transport coordinates
    as tiebreakers) or the kept row is not deterministic.
    """
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    return df.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) == 1).drop(_RANK)


def newest_first(*cols: str) -> list[Column]:
    """Descending order over several columns, NULLs last."""
    return [F.col(c).desc_nulls_last() for c in cols]


def drop_duplicate_messages(df: DataFrame, id_cols: Sequence[str] = MESSAGE_ID,
                            first_by: str = "ingested_at") -> DataFrame:
    """At-least-once delivery repair: one row per message identity, keeping
    the earliest landed copy."""
    return latest_per_key(df, list(id_cols), [F.col(first_by).asc_nulls_last()])


def duplicate_messages(df: DataFrame, id_cols: Sequence[str] = MESSAGE_ID) -> DataFrame:
    """Messages that landed more than once, with their copy count."""
    return (
        df.groupBy(*id_cols)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )
