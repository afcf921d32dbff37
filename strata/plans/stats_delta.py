"""User statistics kept by deltas (I8): a run costs what its change costs.

Counts follow from signed rows: the enriched rows of rewritten buckets as they were (-1) and as they
are (+1), which cancel where nothing changed.  A distinct count and a minimum don't add up like that, so
three tables stand between the enriched table and the result, each a function of the one before:

* ``state``: (group, e-mail, landing time) with the number of rows and of matched rows: linear, so a delta is added to it.
  It is bucketed by e-mail: all rows of one e-mail are in one bucket.
* ``cells``: (group, state bucket) with the five aggregates.  Buckets share no e-mail, so distinct e-mails of a
  group are the sum over its cells, and its first and last landing the least and greatest.  Only cells of
  rewritten state buckets are made again, from those buckets.  Cells are bucketed by group.
* ``groups``: the result rows, made again only from rewritten cell buckets, which hold all cells of their groups.

A group that holds a third of all users costs a run the cells its change touches, not its users.  Each table's commit
carries the version of the table before it that it reflects, so a run that stops half-way is picked up by the next one,
stage by stage, and no delta is added twice.  Where a version has expired, the stage is made anew in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.text import label_unknown
from strata.sources.tables import VersionedTable, bucket_of

GROUP = ["gender", "department", "birth_year"]
STATE_KEY = [*GROUP, "email", "email_key", "seen"]
FIGURES = ["total_users", "unique_emails", "matched_db_users", "first_seen", "last_seen"]
_GONE = "_strata_gone"


def group_key() -> Column:
    """One text per group, null birth years included (a join on the columns would lose those)."""
    return F.to_json(F.struct(*GROUP))


def weights(enriched: DataFrame, sign: int = 1) -> DataFrame:
    """(group, e-mail, landing time) of enriched rows with signed counts.  Rows without an e-mail
    are spread over buckets by their landing time."""
    return enriched.groupBy(
        label_unknown("gender").alias("gender"), label_unknown("department").alias("department"), F.col("birth_year"),
        F.col("email"), F.coalesce("email", F.col("api_ingested_at").cast("string"), F.lit("")).alias("email_key"),
        F.col("api_ingested_at").alias("seen"),
    ).agg((F.count(F.lit(1)) * sign).alias("n"), (F.count("db_id") * sign).alias("matched"))


def folded(rows: DataFrame) -> DataFrame:
    """Counts of equal keys added up; what comes to nothing goes."""
    return rows.groupBy(*STATE_KEY).agg(F.sum("n").alias("n"), F.sum("matched").alias("matched")).filter(
        (F.col("n") != 0) | (F.col("matched") != 0))


def signed(then: DataFrame, now: DataFrame) -> DataFrame:
    """The delta between two states of the same buckets."""
    return folded(weights(then, -1).unionByName(weights(now)))


def cells_of(state: DataFrame, buckets: int) -> DataFrame:
    """The aggregates of every group in every state bucket."""
    return state.groupBy(group_key().alias("group_key"), bucket_of(["email_key"], buckets).alias("cell"), *GROUP).agg(
        F.sum("n").alias("total_users"), F.count_distinct("email").alias("unique_emails"), F.sum("matched").alias("matched_db_users"),
        F.min("seen").alias("first_seen"), F.max("seen").alias("last_seen"))


def groups_of(cells: DataFrame) -> DataFrame:
    return cells.groupBy("group_key", *GROUP).agg(
        *[F.sum(c).alias(c) for c in FIGURES[:3]], F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def replaced(keys: list[str], change: DataFrame, then: DataFrame) -> DataFrame:
    """The new rows, and a row to take away for every key of old that has none now."""
    gone = then.select(*keys).distinct().join(change.select(*keys), keys, "left_anti").withColumn(_GONE, F.lit(True))
    return change.withColumn(_GONE, F.lit(False)).unionByName(gone, allowMissingColumns=True)


def swap(keys: list[str]):
    """Merge rule: the change's row of a key stands instead of the target's."""
    def combine(target: DataFrame, change: DataFrame) -> DataFrame:
        kept = target.drop(_GONE).join(change.select(*keys), keys, "left_anti")
        return kept.unionByName(change.filter(~F.col(_GONE)).drop(_GONE))

    return combine


def _follow(source: VersionedTable, target: VersionedTable, full, change, combine):
    """Bring ``target`` up to the head of ``source``; its commit carries that version."""
    head, now = target.latest(), source.latest()
    if head is not None and head.mark == str(now.version):
        return head
    moved = source.changed_since(int(head.mark)) if head is not None and head.mark else None
    if moved is None:
        return target.overwrite(full(source.read()), operation="rebuild", mark=str(now.version))
    done = target.merge(change(*moved), combine=combine, operation="delta", mark=str(now.version))
    if done.version == head.version:  # nothing changed for this table: only its mark moves
        done = target._commit("mark", head.parts, target.schema(), base=head, mark=str(now.version))
    return done


def refresh_stats(spark: SparkSession, layout, enriched: VersionedTable, name: str = "gold/user_stats_inc"):
    """Bring the statistics ``name`` up to the head of ``enriched``; returns their commit."""
    state = layout.table(spark, f"{name}_state", ["email_key"])
    cells = layout.table(spark, f"{name}_cells", ["group_key"])
    groups = layout.table(spark, f"{name}_groups", ["group_key"])
    _follow(enriched, state, lambda rows: folded(weights(rows)), signed, lambda t, c: folded(t.unionByName(c)))

    def cell_change(then: DataFrame, now: DataFrame) -> DataFrame:
        cell = bucket_of(["email_key"], state.buckets).alias("cell")
        return replaced(["group_key", "cell"], cells_of(now, state.buckets), then.select(group_key().alias("group_key"), cell))

    _follow(state, cells, lambda rows: cells_of(rows, state.buckets), cell_change, swap(["group_key", "cell"]))
    done = _follow(cells, groups, groups_of, lambda then, now: replaced(["group_key"], groups_of(now), then), swap(["group_key"]))
    out = layout.table(spark, name)  # the result as its readers know it: a row for each group
    head = out.latest()
    if head is None or head.mark != str(done.version):
        head = out.overwrite(groups.read().select(*GROUP, *FIGURES), operation="replace", mark=str(done.version))
    return head


__all__ = ["cells_of", "folded", "groups_of", "refresh_stats", "signed", "weights"]
