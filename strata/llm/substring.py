"""Substring dedup over words (operator 2): Rabin-Karp hashes of every window
of 13 words, grouped by Spark; repeated windows merge into maximal intervals.

A window is removed where its word sequence also starts in a document with a
smaller doc_id; windows are judged on the input.

1. Blocks (ranges of doc_ids) count their window hashes in hash buckets (``frequencies``, a few bytes each).
   A window that starts once in all the corpus goes no further.
2. Of the others, blocks send two independent 64-bit hashes; a bucket finds the first
   block of every pair and tells the later ones.  Within a block the first
   document of a pair is found by sorting.  So windows count as equal when 128 bits agree: among
   10^14 windows a false pair has a chance of about 10^-11.

Defined results: null or empty text has no words; texts of fewer than 13 words
lose nothing; equal doc_ids aren't smaller than each other, so rows that repeat
a doc_id don't remove each other's windows; a null doc_id is larger than all
others and equal to itself; every input row gives one row; an empty table
gives none; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.blocks import HASHES, REPLY, Block, Words, buckets_for, covered, deal, make_blocks, pair_groups, runs
from strata.llm.frequencies import FREQUENCIES, codes_for, counted_rows, frequencies
from strata.llm.tables import id_text
from strata.session import materialize

WINDOW = 13
#: Words are runs of bytes other than space, \t \n \v \f \r.
IS_WORD = np.ones(256, bool)
IS_WORD[[9, 10, 11, 12, 13, 32]] = False
RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept_text string"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _emit(window: int, buckets: int):
    def run(t: pa.Table) -> pa.Table:
        block = Block(t)
        _, h = Words(block.texts, IS_WORD).windows(window)
        return counted_rows(block, *np.unique(h, return_counts=True), buckets)
    return run


def _repeated(words: Words, window: int, buckets: int, told: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and both hashes of the windows that start elsewhere too (or whose 32 bits do)."""
    at, h = words.windows(window)
    distinct, place = np.unique(h, return_inverse=True)
    keep = codes_for(distinct, buckets, told)[place] > 0
    return at[keep], h[keep], words.second(window, at[keep])


def _emit_pairs(window: int, buckets: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        block = Block(docs)
        _, a, b = _repeated(Words(block.texts, IS_WORD), window, buckets, told)
        _, first = np.unique(pair_groups(a, b), return_index=True)
        a, b = a[first], b[first]
        got = list(deal(a, buckets))
        return pa.table({"bucket": pa.array([k for k, _ in got], pa.int32()), "rank": pa.array([block.rank] * len(got), pa.int32()),
                         "block": pa.array([block.block] * len(got), pa.int32()),
                         "hashes": pa.array([a[at].tobytes() + b[at].tobytes() for _, at in got], pa.binary())})
    return run


def _halves(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(blob, "<u8")
    return x[:len(x) // 2], x[len(x) // 2:]


def _judge(t: pa.Table) -> pa.Table:
    """Tell every block the pairs that start in a block of smaller ids."""
    parts = [_halves(x) for x in t.column("hashes").to_pylist()]
    n = [len(a) for a, _ in parts]
    a, b = (np.concatenate(x) for x in zip(*parts))
    rank, block = (np.repeat(t.column(c).to_numpy(), n) for c in ("rank", "block"))
    group = pair_groups(a, b)
    first = np.full(int(group.max()) + 1 if len(group) else 0, np.iinfo(np.int64).max)
    np.minimum.at(first, group, rank)
    late = rank > first[group]
    order = np.argsort(block[late], kind="stable")
    a, b, block = a[late][order], b[late][order], block[late][order]
    edges = np.flatnonzero(np.diff(block)) + 1
    split = np.split(np.arange(len(block)), edges) if len(block) else []
    return pa.table({"block": pa.array([block[x[0]] for x in split], pa.int32()),
                     "hashes": pa.array([a[x].tobytes() + b[x].tobytes() for x in split], pa.binary())})


def _remove(window: int, buckets: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        block = Block(docs)
        words = Words(block.texts, IS_WORD)
        kind = told.column("kind").to_numpy()
        at, a, b = _repeated(words, window, buckets, told.filter(pa.array(kind == 1)))
        late = [_halves(x) for x in told.filter(pa.array(kind == 2)).column("codes").to_pylist()]
        n = sum(len(x) for x, _ in late)
        group = pair_groups(np.concatenate([x for x, _ in late] + [a]), np.concatenate([y for _, y in late] + [b]))
        marked = np.zeros(int(group.max()) + 1 if len(group) else 0, bool)
        marked[group[:n]] = True
        group = group[n:]
        # the first document of each pair within this block
        who = block.order[words.doc[at]]
        first = np.full(len(marked), np.iinfo(np.int64).max)
        np.minimum.at(first, group, who)
        gone = marked[group] | (who > first[group])
        mask = covered(at[gone], at[gone] + window, len(words.hash))
        out = []
        for i, text in enumerate(block.texts):
            a, b = words.first[i], words.first[i + 1]
            cut = mask[a:b]
            split = text.split()  # bytes.split() cuts at the same six bytes
            if cut.any():
                s, e = runs(cut)
                spans = [{"start": x, "end": y} for x, y in zip(s.tolist(), e.tolist())]
                kept = [w for w, c in zip(split, cut.tolist()) if not c]
            else:
                spans, kept = [], split
            out.append((len(split), int(cut.sum()), spans, b" ".join(kept)))
        n, gone_n, spans, kept = zip(*out) if out else ((), (), (), ())
        return pa.table({"doc_id": block.doc_id, "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(gone_n, pa.int64()),
                         "spans": pa.array(spans, SPANS), "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})
    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_removed, spans of removed words, and
    kept_text, the words that stay, joined by one space."""
    blocks, total = make_blocks(id_text(docs, doc_id, text))
    buckets = buckets_for(total / 6)
    of_block = blocks.groupBy("block")
    told = materialize(of_block.applyInArrow(_emit(window, buckets), HASHES).groupBy("bucket").applyInArrow(frequencies, FREQUENCIES), "substring-codes")
    late = of_block.cogroup(told.groupBy("block")).applyInArrow(_emit_pairs(window, buckets), HASHES).groupBy("bucket").applyInArrow(_judge, REPLY)
    both = told.withColumn("kind", F.lit(1)).unionByName(
        late.select("block", F.lit(0).alias("bucket"), F.col("hashes").alias("codes"), F.lit(2).alias("kind")))
    return of_block.cogroup(both.groupBy("block")).applyInArrow(_remove(window, buckets), RESULT)
