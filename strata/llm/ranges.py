"""Cutting a table into ranges of an integer key, by quantiles.

``cut_points`` gives n - 1 values (as many as ranges, like the bounds of Spark's own range
partitioning); ``range_of`` maps keys to ranges in numpy.  A value that fills whole
ranges by itself (one key may hold a third of all rows) is spread over all
the ranges it fills, by a second hash; null keys form ranges of their own at the end.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: items on the sketch's lowest level: a cut's rank is off by about 0.01 % of the rows, and the sketch has under 2 MB
SKETCH_K = 32768


def cut_points(df: DataFrame, key: str, n: int) -> np.ndarray:
    """Upper bounds of the first n - 1 of n ranges of about equal row counts."""
    if n < 2:
        return np.empty(0, np.int64)
    # a KLL sketch keeps whole 64-bit values (percentile_approx works in doubles, which can't tell ids above 2^53 apart)
    sketch = F.kll_sketch_agg_bigint(F.col(key).cast("long"), SKETCH_K)
    some = df.filter(F.col(key).isNotNull()).agg(F.count(F.lit(1)).alias("n"), sketch.alias("s")).filter("n > 0")
    ranks = F.array(*[F.lit(i / n) for i in range(1, n)])
    got = some.select(F.kll_sketch_get_quantile_bigint("s", ranks).alias("q")).first()
    return np.sort(np.array(got["q"] if got else [], np.int64))


def range_of(key: np.ndarray, null: np.ndarray, salt: np.ndarray, cuts: np.ndarray, null_ranges: int = 1):
    """(range, rank) of every key.  Ranges ascend with the key; rank is the
    first range of a spread key, so equal keys have equal ranks."""
    lo, hi = np.searchsorted(cuts, key, "left"), np.searchsorted(cuts, key, "right")
    many = hi - lo > 1  # the key is the bound of several ranges: it fills those after the first
    rank = np.where(many, lo + 1, lo)
    out = np.where(many, rank + salt.astype(np.uint64) % np.maximum(hi - lo - 1, 1).astype(np.uint64), lo).astype(np.int64)
    last = len(cuts) + 1
    out = np.where(null, last + (salt.astype(np.uint64) % np.uint64(null_ranges)).astype(np.int64), out)
    return out.astype(np.int32), np.where(null, last, rank).astype(np.int32)
