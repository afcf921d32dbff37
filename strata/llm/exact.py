"""Exact deduplication (operator 3): group by a 128-bit content hash, keep one
row, and compare bytes inside the groups.

Native: DataFrame functions only.  The hash (``md5``) and the text itself are
the grouping key, so Spark's own aggregation compares bytes inside every hash
group, and copies meet already in the map tasks: a group that holds a third
of all rows leaves one row per map task.  The join back to the rows has the
hash and a SHA-256 as key; a hot group there is split by adaptive skew joins.

Defined results: a null text counts as empty; a null doc_id is smaller than
every other, so it stays only if all its copies have null ids; rows that repeat
both doc_id and text count in ``group_size`` and get the same answer (the
filter ``exact_dedup`` leaves one of them); an empty table gives no rows;
further columns are ignored by ``exact_groups`` and kept by ``exact_dedup``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import id_text


def _hashed(text):
    return [F.md5(text).alias("_h"), F.sha2(text, 256).alias("_sha")]


def text_classes(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """One row per distinct text: hash, SHA-256, the id that stays, size."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    pick = F.max if keep == "largest" else F.min
    return (
        docs.select("doc_id", text.alias("_t"))
        .groupBy(F.md5("_t").alias("_h"), "_t")
        .agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("_h", F.sha2("_t", 256).alias("_sha"), "keep_id", "group_size")
    )


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 keep: str = "largest") -> DataFrame:
    """Every row with the row of its text that stays: doc_id, keep_id,
    group_size, kept, text_sha256.  ``keep``: ``largest`` or ``smallest`` id."""
    rows = id_text(docs, doc_id, text)
    full = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keyed = rows.select("doc_id", *_hashed(full))
    return (
        keyed.join(text_classes(rows, keep), ["_h", "_sha"])
        .select("doc_id", "keep_id", "group_size",
                F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                F.col("_sha").alias("text_sha256"))
    )


def exact_dedup(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The rows that stay, with all their columns.  Rows that tie on doc_id and
    text are the same document: the one whose other columns hash highest stays,
    and wholly equal rows collapse."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    other = [c for c in docs.columns if c != "text"]
    rank = F.struct((F.col("doc_id") if keep == "largest" else -F.col("doc_id")).alias("a"),
                    F.xxhash64(*other).alias("b"))
    best = (
        docs.select(F.md5(text).alias("_h"), text.alias("_t"), rank.alias("_r"))
        .groupBy("_h", "_t").agg(F.max("_r").alias("_best"), F.count(F.lit(1)).alias("_n"))
        .select("_h", F.sha2("_t", 256).alias("_sha"), "_best")
    )
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), *_hashed(text), rank.alias("_r"))
    stay = keyed.join(best, ["_h", "_sha"]).filter(F.col("_r").eqNullSafe(F.col("_best")))
    # what is left has one row per text, but for wholly equal rows
    return stay.groupBy("_h", "_sha").agg(F.first("_row").alias("_row")).select("_row.*")
