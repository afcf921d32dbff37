"""Ranked lexical search (operator 13): one Aho-Corasick scan of the documents.

There is no index of the documents.  The terms of all items make one automaton, which every
task builds from a broadcast list and runs over whole texts.  Before the scan a
text is reduced to its word bytes, lower-cased, with one blank for each other byte and at both ends,
and each pattern is a term between two blanks: the blanks guard the
boundaries, so a match is a maximal word and its count is the term's tf.
Matches map to term numbers, and term numbers to the items that hold them.

1. One pass over the documents writes, for each row, its number of terms and the
   (term, tf) pairs of the automaton's matches to the checkpoint folder.
2. Aggregates over those rows give N, L and the df of each term.
3. A second pass over the pairs (not the texts) scores every document against every item
   in integers.  A task keeps the best rows of each item of what it has read, so the rows that leave it follow the
   items; the tasks' best are merged in two steps.

The broadcast holds the distinct terms of a group of items, at most ``TERM_BYTES`` of
them by measure; where the items have more, they are dealt to as many groups as it takes, and
each group is a pass of its own.  (An item is in one group whole: a single item
of more terms than that is the one thing that can exceed the bound.)

All arithmetic but the term weight is in 64-bit integers, divisions rounding down.

Defined results: a null or empty text has no terms, doesn't count in N and is no result; a null item text or one
without terms gives no rows; items of one id (null ids too) are one item with the terms of all; rows
that repeat doc_id or text are ranked each, a null doc_id after all others of its score; empty tables give no
rows; further columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.decontaminate import words
from strata.llm.tables import id_text, ship_package
from strata.session import materialize

TOP = 50
#: distinct terms of one automaton; it takes some 50 bytes for each of theirs in every worker
TERM_BYTES = 4 << 20
#: scores (documents x items) that a task holds at once
SCORES = 1 << 20
#: Word bytes are digits, letters and bytes from 128 on; A-Z fold to a-z.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
HITS = "doc_id long, n long, terms array<int>, tfs array<long>"
BEST = "item int, doc_id long, score long"


# ------------------------------------------------------------------- terms
def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item_id, term) of all items."""
    return items.select(F.col(item_id).alias("item_id"), F.explode(words(F.col(text))).alias("term")).distinct()


def automaton(terms: list[str]):
    """Aho-Corasick automaton of the terms between blanks.  UTF-8 bytes stand as
    Latin-1 characters, one for each."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, t in enumerate(terms):
        found.add_word(f" {t.encode().decode('latin-1')} ", i)
    found.make_automaton()
    return found


_LAST: list = [None, None]


def _automaton_of(key: str, terms: list[str]):
    """The worker's automaton of a scan, built once and kept until the next one."""
    if _LAST[0] != key:
        _LAST[:] = [key, automaton(terms)]
    return _LAST[1]


def term_counts(text: bytes, found) -> tuple[int, Counter]:
    """Number of terms of a whole text, and tf of each of the automaton's terms in it."""
    low = b" " + text.translate(NORMAL) + b" "
    return len(low.split()), Counter(map(itemgetter(1), found.iter(low.decode("latin-1"))))


def _scan(key: str, terms):
    def run(batches):
        found = _automaton_of(key, terms.value) if terms.value else None
        for b in batches:
            ids, ns, at, tf, ends = b.column("doc_id"), [], [], [], [0]
            for x in b.column("text"):
                text = x.as_py() or b""
                n, tfs = term_counts(text, found) if found else (len(text.translate(NORMAL).split()), {})
                ns.append(n)
                at.extend(tfs.keys())
                tf.extend(tfs.values())
                ends.append(len(at))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, t)) for v, t in ((at, pa.int32()), (tf, pa.int64()))]
            yield pa.record_batch({"doc_id": ids, "n": pa.array(ns, pa.int64()), "terms": lists[0], "tfs": lists[1]})
    return run


# ------------------------------------------------------------------ scores
def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def contributions(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """Score that a term of a weight adds to a document of n terms that holds it tf times."""
    if len(n) and 50 * int(n.max()) * documents >= 1 << 63:  # beyond 64 bits: in Python's integers
        m = np.array([50 + 50 * int(x) * documents // length for x in n], np.int64)
    else:
        m = 50 + 50 * n * documents // length
    return weight * (1_000_000_000 * tf // (1000 * tf + 20 * m))


def _best_of(item: np.ndarray, doc: np.ndarray, null: np.ndarray, score: np.ndarray, top: int) -> np.ndarray:
    """Places of the first ``top`` rows of each item."""
    order = np.lexsort((doc, null, -score, item))
    item = item[order]
    first = np.ones(len(item), bool)
    first[1:] = item[1:] != item[:-1]
    start = np.flatnonzero(first)
    rank = np.arange(len(item)) - np.repeat(start, np.diff(np.append(start, len(item))))
    return order[rank < top]


def _score(shared, documents: int, length: int, items: int, top: int):
    """Best rows of each item among those a task reads."""
    def run(batches):
        weight, first, holders = shared.value
        best = [np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)]
        for b in batches:
            step = max(1, SCORES // max(1, items))
            for lo in range(0, b.num_rows, step):
                part = b.slice(lo, step)
                terms = part.column("terms")
                size = np.diff(terms.offsets.to_numpy())
                term = terms.flatten().to_numpy()
                tf = part.column("tfs").flatten().to_numpy()
                row = np.repeat(np.arange(part.num_rows), size)
                gain = contributions(weight[term], tf, part.column("n").to_numpy()[row], documents, length)
                # every pair (document, item) of a shared term
                many = first[term + 1] - first[term]
                end = np.cumsum(many)
                held = holders[np.repeat(first[term] - end + many, many) + np.arange(end[-1] if len(end) else 0)]
                scores = np.zeros((part.num_rows, items), np.int64)
                np.add.at(scores.ravel(), np.repeat(row, many) * items + held, np.repeat(gain, many))
                at, item = np.nonzero(scores)
                ids = part.column("doc_id")
                null = np.array(ids.is_null())
                doc = ids.fill_null(0).to_numpy(zero_copy_only=False)
                new = [item.astype(np.int32), doc[at], null[at], scores[at, item]]
                best = [np.concatenate(x) for x in zip(best, new)]
                keep = _best_of(*best, top)
                best = [x[keep] for x in best]
        yield pa.record_batch({"item": pa.array(best[0]), "doc_id": pa.array(best[1], mask=best[2]), "score": pa.array(best[3])})
    return run


def _first(df: DataFrame, keys: list, top: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= top)


def _search(rows: DataFrame, pairs: DataFrame, top: int) -> DataFrame:
    """The best rows for one group of items."""
    spark = rows.sparkSession
    # a group's distinct terms and items: bounded by TERM_BYTES
    held = pairs.groupBy("term").agg(F.collect_list("item_id").alias("items"), F.max(F.col("item_id").isNull()).alias("null")).collect()
    names = sorted({i for r in held for i in r["items"]}) + ([None] if any(r["null"] for r in held) else [])
    number = {i: k for k, i in enumerate(names)}
    terms = sorted(r["term"] for r in held)
    place = {t: k for k, t in enumerate(terms)}
    shipped = spark.sparkContext.broadcast(terms)
    hits = materialize(rows.mapInArrow(_scan(uuid.uuid4().hex, shipped), HITS), "lexical-hits")
    documents, length = hits.filter("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = hits.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1))).collect()  # a number for each term
    weight = np.zeros(len(terms) + 1, np.int64)
    for term, n in df:
        weight[term] = term_weight(documents, n)
    pair = np.array(sorted((place[r["term"]], number[i]) for r in held for i in r["items"] + ([None] if r["null"] else [])), np.int64).reshape(-1, 2)
    first = np.searchsorted(pair[:, 0], np.arange(len(terms) + 1))
    shared = spark.sparkContext.broadcast((weight, first, pair[:, 1]))
    best = hits.filter(F.size("terms") > 0).mapInArrow(_score(shared, documents, length, len(names), top), BEST)
    best = _first(best.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(64))), ["item", "_part"], top, "_r")
    named = spark.createDataFrame(list(enumerate(names)), f"item int, item_id {dict(pairs.dtypes)['item_id']}")
    return _first(best, ["item"], top, "rank").join(named, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", term_bytes: int = TERM_BYTES) -> DataFrame:
    """Per item: item_id, rank (from 1), doc_id, score of its ``top`` documents."""
    ship_package(docs.sparkSession)
    rows = id_text(docs, doc_id, text).select("doc_id", F.col("text").cast("binary").alias("text"))
    pairs = materialize(item_terms(items, item_id, item_text), "lexical-terms")
    size = pairs.agg(F.sum(F.octet_length("term") + 2)).first()[0] or 0
    groups = max(1, -(-size // term_bytes))
    out = None
    for g in range(groups):
        mine = pairs if groups == 1 else pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g)
        found = _search(rows, mine, top)
        out = found if out is None else out.unionByName(found)
    return out
