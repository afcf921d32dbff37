"""Benchmark decontamination (operator 10): winnowing.

Native: DataFrame functions only.  Every text becomes an array of words; the
hashes of all 5-grams are winnowed (the minimum of each 6 consecutive ones is
a fingerprint).  Two texts that share 10 consecutive words share a fingerprint
there, whatever surrounds it.  Document fingerprints meet the distinct benchmark
fingerprints in a semi join; hits are then extended: the up to six 10-word
windows around a hit are compared, as words, with the benchmark's windows, so
the result is exact and hash collisions only cost work.  (A minimum is written
where it changes and at every sixth place, so no repetition hides one.)

An item of fewer than 10 words is one window.  It is too short for the winnowing
guarantee, so items of n < 10 words are looked up among all n-grams of the
documents (done only for lengths n that occur among the items).

The benchmark side is broadcast by Spark only where its size is under the
session's threshold; else both sides shuffle.  A fingerprint that very many
documents share is one row on the benchmark side and is spread by document on
the other, and a document's hits are keyed by its content hash.

Defined results: null or empty text has no words, so no hits; results depend on
the text alone, so null or repeated doc_ids and repeated rows each get their own
row; null item texts are no items, null item_ids take part as the string
``null``; items of one id and text count once; empty tables work; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import id_text
from strata.session import materialize


WINDOW = 10
GRAM = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words after lower-casing A-Z: runs of digits, letters and all that is not ASCII."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), NOT_WORD), "")


def _starts(size: Column, k: int) -> Column:
    """0 .. size-k, or nothing."""
    return F.when(size >= k, F.sequence(F.lit(0), size - k)).otherwise(F.array().cast("array<int>"))


def bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often the
    body uses it (Catalyst would inline a projected column into every use)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def gram_hashes(hashes: Column, k: int) -> Column:
    """Hashes of all k-grams, from the word hashes."""
    return F.transform(_starts(F.size(hashes), k), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]))


def winnow(g: Column, span: int) -> Column:
    """(pos, fp): the minimum of each ``span`` consecutive grams, where it
    changes and at every ``span``-th place, so at most span - 1 places before
    any window there is a row with that window's minimum."""
    least = F.transform(_starts(F.size(g), span), lambda i: F.least(*[F.get(g, i + j) for j in range(span)]))
    return bind(least, lambda m: F.filter(
        F.transform(m, lambda x, i: F.when((i % span == 0) | (F.get(m, i - 1) != x), F.struct(i.alias("pos"), x.alias("fp")))),
        lambda s: s.isNotNull()))


def fingerprints(texts: DataFrame, *keep: str, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """keep..., pos, fp: the winnowed ``gram``-gram hashes of ``text``."""
    marks = bind(F.transform(words(F.col("text")), lambda x: F.xxhash64(x)), lambda h: bind(
        gram_hashes(h, gram), lambda g: winnow(g, window - gram + 1)))
    return texts.select(*keep, F.inline(marks))


def _joined(w: Column, start: Column, n) -> Column:
    return F.array_join(F.slice(w, start + 1, n), " ")


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """item, n, key: every window of every item (short items: the whole)."""
    found = bind(words(F.col("text")), lambda w: bind(F.least(F.size(w), F.lit(window)), lambda n: F.transform(
        F.when(n > 0, F.sequence(F.lit(0), F.size(w) - n)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(n.alias("n"), _joined(w, i, n).alias("key")))))
    return items.select("item", F.inline(found)).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document row: doc_id, text_md5, n_words, n_hit, spans (start word and
    length of each benchmark window found) and item_ids (strings, sorted)."""
    rows = id_text(docs, doc_id, text)
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"),
                             F.col(item_text).alias("text")).filter(F.col("text").isNotNull()).distinct()
    content = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("_h")
    windows = item_windows(items, window)
    short = [r[0] for r in windows.filter(F.col("n") < window).select("n").distinct().collect()]  # at most 9 numbers
    # where long windows may start: around each fingerprint shared with the benchmark
    marks = fingerprints(items, "item", window=window, gram=gram).select("fp").distinct()
    near = (
        fingerprints(rows.select(content, "text"), "_h", window=window, gram=gram)
        .join(marks, "fp", "left_semi")
        .select("_h", F.explode(F.sequence(F.col("pos"), F.col("pos") + (window - gram))).alias("start"),
                F.lit(window).alias("n"))
    )
    for n in sorted(short):
        keys = windows.filter(F.col("n") == n).select(F.xxhash64("key").alias("fp")).distinct()
        grams = bind(words(F.col("text")), lambda w: F.transform(
            _starts(F.size(w), n), lambda i: F.struct(i.alias("start"), F.xxhash64(_joined(w, i, n)).alias("fp"))))
        near = near.unionByName(rows.select(content, F.inline(grams)).join(keys, "fp", "left_semi")
                                .select("_h", "start", F.lit(n).alias("n")))
    near = near.groupBy("_h").agg(F.collect_set(F.struct("start", "n")).alias("_near"))
    # the whole words once more, for every document; windows only where near
    seen = bind(words(F.col("text")), lambda w: F.struct(
        F.greatest(F.size(w), F.lit(0)).cast("long").alias("n_words"),
        F.transform(F.filter("_near", lambda x: x["start"] + x["n"] <= F.size(w)), lambda x: F.struct(
            x["start"].alias("start"), x["n"].alias("n"), _joined(w, x["start"], x["n"]).alias("key"))).alias("_cand")))
    read = (
        rows.select("doc_id", content, "text").join(near, "_h", "left")
        .select("doc_id", "_h", F.inline(F.array(seen)))
    )
    read = materialize(read, "decontaminate")
    hits = (
        read.filter(F.size("_cand") > 0).select("_h", "_cand").dropDuplicates(["_h"])
        .select("_h", F.explode("_cand").alias("c")).select("_h", "c.start", "c.n", "c.key")
        .join(windows, ["n", "key"])
    )
    spans = hits.select("_h", "start", "n").distinct()
    covered = (
        spans.select("_h", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("_p"))
        .distinct().groupBy("_h").agg(F.count(F.lit(1)).alias("n_hit"))
    )
    found = hits.select("_h", "item").distinct().groupBy("_h").agg(F.array_sort(F.collect_list("item")).alias("item_ids"))
    at = spans.groupBy("_h").agg(F.array_sort(F.collect_list(F.struct("start", "n"))).alias("spans"))
    per_text = covered.join(found, "_h").join(at, "_h")
    return (
        read.select("doc_id", "_h", "n_words").join(per_text, "_h", "left")
        .select("doc_id", F.col("_h").alias("text_md5"), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                F.coalesce("spans", F.array().cast("array<struct<start:int,n:int>>")).alias("spans"),
                F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without any benchmark window, with all their columns."""
    hit = contamination(docs, benchmark).filter(F.col("n_hit") > 0).select(F.col("text_md5").alias("_hit")).distinct()
    content = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return docs.join(hit, content == F.col("_hit"), "left_anti")
