"""Keep an expensive per-row expression from being evaluated more than once.

Catalyst pushes a filter below a projection by substituting the projected
expressions into the predicate.  When the projection reads fields out of a
parsed payload, the parse is then repeated inside the filter, once per
referenced field, and again in the projection.  Emitting the fields through a
one-element ``inline`` generator keeps filters on them above the generator,
so the payload is parsed exactly once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fenced_select(df: DataFrame, *cols: str | Column) -> DataFrame:
    """``df.select(*cols)`` that later filters cannot be inlined into."""
    return df.select(F.inline(F.array(F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols]))))
