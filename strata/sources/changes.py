"""Change feed from two snapshots of a keyed table.

``snapshot_changes`` compares a before and an after snapshot with one
full-outer join on the key and emits change envelopes: ``c`` for new keys,
``d`` for vanished keys, ``u`` for changed rows, nothing for unchanged rows.
``initial_snapshot`` emits ``r`` (read) envelopes for a first load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.jsonpath import to_payload


def _image(df: DataFrame, key: str, cols: Sequence[str], name: str) -> DataFrame:
    return df.select(F.col(key).alias("_k"), F.struct(*[F.col(c) for c in cols]).alias(name))


def snapshot_changes(before: DataFrame, after: DataFrame, key: str, ts_ms: Column | int,
                     cols: Sequence[str] | None = None) -> DataFrame:
    """Envelopes (key, before, after, op, ts_ms) turning ``before`` into ``after``."""
    cols = list(cols or after.columns)
    ts = ts_ms if isinstance(ts_ms, Column) else F.lit(ts_ms).cast("long")
    b = _image(before, key, cols, "before")
    a = _image(after, key, cols, "after")
    j = b.join(a, "_k", "full_outer")
    op = (
        F.when(F.col("before").isNull(), F.lit("c"))
        .when(F.col("after").isNull(), F.lit("d"))
        .when(~F.col("before").eqNullSafe(F.col("after")), F.lit("u"))
    )
    return (
        j.select(F.col("_k").alias(key), "before", "after", op.alias("op"), ts.alias("ts_ms"))
        .filter(F.col("op").isNotNull())
    )


def initial_snapshot(df: DataFrame, key: str, ts_ms: Column | int,
                     cols: Sequence[str] | None = None) -> DataFrame:
    """``r`` envelopes for every row of a first snapshot."""
    cols = list(cols or df.columns)
    ts = ts_ms if isinstance(ts_ms, Column) else F.lit(ts_ms).cast("long")
    image = F.struct(*[F.col(c) for c in cols])
    image_type = df.select(image.alias("_i")).schema["_i"].dataType
    return df.select(
        F.col(key),
        F.lit(None).cast(image_type).alias("before"),
        image.alias("after"),
        F.lit("r").alias("op"),
        ts.alias("ts_ms"),
    )


def envelope_payload(changes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Envelopes to JSON message text (``before``/``after`` NULL are omitted),
    keeping the ``keep`` columns alongside."""
    fields = [c for c in ("before", "after", "op", "ts_ms") if c in changes.columns]
    return changes.select(*keep, to_payload(*fields).alias("payload"))
