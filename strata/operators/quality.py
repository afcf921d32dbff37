"""Data-quality and reconciliation checks (M1-M8).

Each check returns a small DataFrame of violations (or one row of counts);
``quality_gate`` turns a set of them into a pass/fail decision.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.rollup import duplicate_keys, match_rate, side_by_side_counts


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M1: keys that appear more than once."""
    return duplicate_keys(df, keys)


def layer_reconciliation(upstream: DataFrame, downstream: DataFrame,
                         names: tuple[str, str] = ("bronze", "silver")) -> DataFrame:
    """M2: both counts in one row plus whether upstream >= downstream."""
    a, b = names
    return side_by_side_counts({a: upstream, b: downstream}).withColumn(
        "consistent", F.col(a) >= F.col(b)
    )


def state_diff(first: DataFrame, second: DataFrame) -> DataFrame:
    """M4: rows in one state but not the other (both directions, multiset)."""
    return first.exceptAll(second).withColumn("side", F.lit("only_first")).unionByName(
        second.exceptAll(first).withColumn("side", F.lit("only_second"))
    )


def row_hash(columns: Sequence[str], seed: int = 0) -> Column:
    """64-bit hash of a row.  Nulls are hashed as such: Spark's hash alone passes over them, so ('a', null) and
    (null, 'a') would be equal."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


def fingerprint_diff(first: DataFrame, second: DataFrame, buckets: int = 1024, keys: Sequence[str] | None = None) -> DataFrame:
    """Buckets of rows (by ``keys``, else by the whole row) in which two states differ as multisets.

    Both sides go into one aggregate: the second side's rows count -1, and two independent 64-bit
    row hashes are added with that sign or xor-ed.  A bucket that holds the same rows on both sides, in any
    order, comes to nothing; one that does so with other rows needs three chance matches at once.  The shuffle carries a row for each bucket
    and task."""
    cols = first.columns
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in (keys or cols)]), F.lit(buckets)).cast("int").alias("bucket")

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*cols).select(bucket, F.lit(sign).alias("s"), row_hash(cols).alias("h"), row_hash(cols, 1).alias("g"))

    signed = side(first, 1).unionByName(side(second, -1))
    sums = signed.groupBy("bucket").agg(
        F.sum("s").alias("rows"), F.sum(F.col("h").cast("decimal(20,0)") * F.col("s")).alias("h"),
        F.sum(F.col("g").cast("decimal(20,0)") * F.col("s")).alias("g"), F.bit_xor("h").alias("x"))
    return sums.filter((F.col("rows") != 0) | (F.col("h") != 0) | (F.col("g") != 0) | (F.col("x") != 0)).select("bucket", "rows")


def state_changes(first: DataFrame, second: DataFrame, buckets: int = 1024, keys: Sequence[str] | None = None) -> DataFrame:
    """``state_diff`` at the cost of the difference: rows are compared only in the buckets whose fingerprints differ (with
    ``keys``, a changed row's old and new state lie in one bucket).  Equal states cost one aggregate."""
    cols = first.columns
    differ = [r["bucket"] for r in fingerprint_diff(first, second, buckets, keys).collect()]  # at most ``buckets`` numbers
    if not differ:
        return first.select(*cols, F.lit("only_first").alias("side")).limit(0)
    here = F.pmod(F.xxhash64(*[F.col(c) for c in (keys or cols)]), F.lit(buckets)).cast("int").isin(*differ)
    return state_diff(first.filter(here).select(*cols), second.filter(here).select(*cols))


def constraint_violations(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = (),
                          max_length: dict[str, int] | None = None, key: str | None = None) -> DataFrame:
    """M6: one row per violated (row, rule) for NOT NULL and VARCHAR(n) rules,
    plus one row per duplicated value for UNIQUE rules."""
    max_length = max_length or {}
    key_col = F.col(key).cast("string") if key else F.lit(None).cast("string")
    rules: list[tuple[str, Column]] = [(f"not_null:{c}", F.col(c).isNull()) for c in not_null]
    rules += [(f"max_length:{c}<={n}", F.length(c) > n) for c, n in max_length.items()]
    parts = []
    if rules:
        tagged = df.select(
            key_col.alias("row_key"),
            F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]).alias("_r"),
        )
        parts.append(
            tagged.select("row_key", F.explode("_r").alias("rule"))
            .filter(F.col("rule").isNotNull())
            .select("rule", "row_key", F.lit(1).cast("long").alias("occurrences"))
        )
    for c in unique:
        parts.append(
            duplicate_keys(df.filter(F.col(c).isNotNull()), [c], "occurrences").select(
                F.lit(f"unique:{c}").alias("rule"), F.col(c).cast("string").alias("row_key"),
                F.col("occurrences"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass
class GateResult:
    passed: bool
    failures: dict[str, int]


class QualityGateFailed(RuntimeError):
    def __init__(self, gate: GateResult):
        super().__init__(f"quality gate: {gate.failures}")
        self.gate = gate


def gate_counts(checks: dict[str, DataFrame]) -> DataFrame:
    """check_name, violations, passed: one row per check, each one aggregate."""
    parts = [df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
             for name, df in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("violations") == 0)


def quality_gate(checks: dict[str, DataFrame]) -> GateResult:
    """M8: every check DataFrame must be empty; failures carry true counts."""
    rows = gate_counts(checks).filter(~F.col("passed")).collect() if checks else []  # one row per check
    failures = {r["check_name"]: r["violations"] for r in rows}
    return GateResult(passed=not failures, failures=failures)


def fanout_check(left: DataFrame, joined: DataFrame) -> DataFrame:
    """A left join must not change the row count."""
    return side_by_side_counts({"left_rows": left, "joined_rows": joined}).filter(
        F.col("left_rows") != F.col("joined_rows")
    )


__all__ = [
    "GateResult",
    "QualityGateFailed",
    "constraint_violations",
    "fanout_check",
    "fingerprint_diff",
    "gate_counts",
    "key_violations",
    "layer_reconciliation",
    "match_rate",
    "quality_gate",
    "state_changes",
    "state_diff",
]
