"""Left join that splits keys which are hot on the right side.

Spark's adaptive execution splits a hot partition of the left side of a left join, but not one of the right side, since every
left row has to meet all its partners in one place.  So the right side's hot keys are found by a count, their rows are
dealt to salts, and the left rows of those keys (which have partners for sure, so an inner join serves) are
repeated once for each salt.  All other rows take the plain left join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY, SALT = "_skew_key", "_skew_salt"


def hot_keys(keyed: DataFrame, above: int) -> DataFrame:
    """key, salts: keys with more than ``above`` rows, and how many parts make them no larger.  There are at most
    rows / above of them, whatever the data."""
    return keyed.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > above).select(
        KEY, F.ceil(F.col("_n") / above).cast("int").alias("_salts"))


def split_left_join(left: DataFrame, right: DataFrame, left_key, right_key, above: int) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` with no group of right rows above about ``above`` in one
    task.  Both sides' columns must differ in name."""
    lk, rk = left.withColumn(KEY, left_key), right.withColumn(KEY, right_key).filter(F.col(KEY).isNotNull())
    hot = hot_keys(rk, above)
    rest = lk.join(hot, KEY, "left_anti").join(rk.join(hot, KEY, "left_anti"), KEY, "left")
    salted = rk.join(hot, KEY).withColumn(SALT, F.pmod(F.xxhash64(*right.columns), F.col("_salts")).cast("int")).drop("_salts")
    every = lk.join(hot, KEY).withColumn(SALT, F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    dealt = every.join(salted, [KEY, SALT]).drop(SALT)
    return rest.unionByName(dealt).drop(KEY)
