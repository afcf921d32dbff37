"""Upsert algebra (I4, I6, I9, I10, I12) as pure DataFrame functions.

Storage is separate: ``VersionedTable.merge`` feeds these the touched slice
of a bucketed table; a catalog with ``MERGE`` uses ``sources.catalog.merge``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.dedup import latest_per_key


class DuplicateSourceKeys(ValueError):
    """Several source rows for one target key (the MERGE cardinality rule)."""


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateSourceKeys(f"duplicate source key {dup[0].asDict()}")


def unique_source(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, failing at run time where several rows have one key (the MERGE
    cardinality rule): the check is part of the plan, no job of its own."""
    n = "_strata_rows"
    text = F.concat(F.lit("duplicate source key "), F.to_json(F.struct(*keys)))
    return (
        df.withColumn(n, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
        .filter(F.when(F.col(n) > 1, F.raise_error(text).cast("boolean")).otherwise(F.lit(True))).drop(n)
    )


def _align(updates: DataFrame, target: DataFrame) -> DataFrame:
    return updates.select(*[F.col(c) for c in target.columns])


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           order: Sequence[str | Column] | None = None, strict: bool = False) -> DataFrame:
    """``MERGE INTO t USING s ON keys WHEN MATCHED UPDATE SET * WHEN NOT MATCHED INSERT *``.

    * ``order=None``: the source row always wins (the plain MERGE).  A duplicate
      source key raises when the plan runs, as MERGE does (``strict``: at once).
    * ``order`` given: a guarded merge, the row that is newest under ``order``
      wins whether it is in the target or the source.  This is idempotent and
      gives the same state for any split of a feed into batches.
    """
    keys = list(keys)
    updates = _align(updates, target)
    if order is None:
        if strict:
            assert_unique(updates, keys)
        # the check stands on one side of the plan only: the other needs the keys, repeated or not
        kept = target.join(updates.select(*keys), on=keys, how="left_anti")
        return kept.unionByName(unique_source(updates, keys))
    return latest_per_key(target.unionByName(updates), keys, order)


def live_rows(df: DataFrame, deleted_col: str = "is_deleted") -> DataFrame:
    """Reader view of a table that keeps tombstones."""
    return df.filter(~F.coalesce(F.col(deleted_col), F.lit(False))).drop(deleted_col)


def upsert_columns(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                   update_cols: Sequence[str],
                   insert_values: dict[str, Column] | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols``.

    Matched rows take ``update_cols`` from the source and keep every other
    column (for example a generated id); new keys are inserted with source
    values, or ``insert_values`` (Columns over the source row) for columns the
    source does not carry.  Several source rows for one key are an error.
    """
    keys = list(keys)
    updates = unique_source(updates, keys)
    insert_values = insert_values or {}
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s_cols = [c for c in updates.columns]
    s = updates.select(
        *[F.col(c).alias(f"_s_{c}") for c in s_cols],
        *[v.alias(f"_s_{c}") for c, v in insert_values.items() if c not in s_cols],
        F.lit(True).alias("_in_s"),
    )
    cond = None
    for k in keys:
        c = F.col(f"t.{k}") == F.col(f"_s_{k}")
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    out = []
    for c in target.columns:
        src = F.col(f"_s_{c}") if (c in s_cols or c in insert_values) else F.lit(None)
        if c in keys:
            out.append(F.coalesce(F.col(f"t.{c}"), src).alias(c))
        elif c in update_cols:
            out.append(F.when(F.col("_in_s"), src).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(F.col("_in_t"), F.col(f"t.{c}")).otherwise(src).alias(c))
    return j.select(*out)


def insert_if_absent(target: DataFrame, new_rows: DataFrame, keys: Sequence[str],
                     order: Sequence[str | Column]) -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING`` (I10): new keys only; among
    several new rows for one key the first under ``order`` wins."""
    keys = list(keys)
    first = _align(latest_per_key(new_rows, keys, order), target)
    fresh = first.join(target.select(*keys), on=keys, how="left_anti")
    return target.unionByName(fresh)


def sync_columns(target: DataFrame, updates: DataFrame) -> DataFrame:
    """``on_schema_change='sync_all_columns'`` (I12): reshape the target to
    the source's columns, adding new ones as NULL and dropping vanished ones."""
    tcols = set(target.columns)
    return target.select(
        *[
            F.col(f.name) if f.name in tcols else F.lit(None).cast(f.dataType).alias(f.name)
            for f in updates.schema.fields
        ]
    )
