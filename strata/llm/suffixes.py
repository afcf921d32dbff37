"""Suffix dedup over bytes (operator 7): hashes at the places of a difference cover, one bucket at
a time.  No suffix is sorted by its bytes: a rank is a hash, and buckets are in the order of hashes.

Removed is every byte covered by a 400-byte string that also starts anywhere
else.  So only suffixes that agree on 400 bytes matter, and the suffix order is
needed up to there:

1. The cover sample.  A perfect difference cover D of v = 133 has, for any two
   positions i and j, a shift d < v that brings both into the sample (offsets in
   the document that are in D modulo v).  If 400 bytes agree at i and j, then the
   sampled suffixes at i + d and j + d agree on 400 - d >= 268 bytes.  Sampled suffixes (9 % of
   all) are ranked by their first 268 bytes: they go to buckets by hash (``frequencies``, so a rank travels in a few
   bytes), and a bucket is sorted at a time.  A rank held by one suffix alone ends there.
2. Ties.  Sampled suffixes of equal rank are sorted, a bucket of ranks at a time,
   by the bytes they bring with them: from 132 before to 400 behind (cut at the
   document's ends).  Equal contexts repeat as a whole, so all their 400-byte strings do.
3. Where contexts under one rank differ, one suffix of each distinct context
   resolves the up to 133 strings around it by their own hashes.

Every repeated pair (i, j) is found: its sampled suffixes share a rank; either
their contexts agree (2), or both contexts have a resolver (3), or a context occurs
twice and is covered by (2).

Bytes are compared through 64-bit Rabin-Karp hashes.  Memory is bounded by a block or a bucket.  A group of copies is one
entry per block and hash.

Defined results: null text is empty; texts under 400 bytes lose nothing;
results do not depend on doc_ids, so null or repeated ones are rows like others;
repeated rows remove each other; an empty table gives no rows; further columns
are ignored.  Kept bytes are binary: a cut may split a character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.blocks import (HASHES, REPLY, SEGMENT, Block, buckets_for, covered, deal, hash_rows, is_in, make_blocks,
                               open_bucket, prefix_sums, read_reply, reply_rows, runs, spans_hash)
from strata.llm.frequencies import FREQUENCIES, codes_for, counted_rows, frequencies
from strata.llm.substring import SPANS
from strata.llm.tables import id_text, lean
from strata.llm.token_store import mix
from strata.session import materialize

LENGTH = 400
#: A perfect difference set modulo 133.
PERIOD = 133
COVER = np.array([1, 10, 11, 13, 27, 31, 68, 75, 83, 110, 115, 121])
RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept binary"
CONTEXT = np.dtype([("c", "<u8"), ("e", "<u8"), ("m", "u1")])
REPEATED, RESOLVE = 1, 2
SLICE_BITS = 3


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of byte spans (starts ascending, spans short), a segment at a time."""
    out = np.empty(len(start), np.uint64)
    a = 0
    while a < len(start):
        lo = start[a]
        b = int(np.searchsorted(start, lo + SEGMENT, "left"))
        sums = prefix_sums(data[lo:end[a:b].max()])
        out[a:b] = spans_hash(sums, start[a:b] - lo, end[a:b] - lo)
        a = b
    return mix(out, seed)


class Sample:
    """The cover sample of a block's documents."""

    def __init__(self, block: Block, length: int):
        self.length, self.short = length, length - PERIOD + 1
        self.data = np.frombuffer(b"".join(block.texts) or b"\0", np.uint8)
        size = np.array([len(t) for t in block.texts], np.int64)
        self.begin = np.cumsum(size) - size
        self.size = size
        at, doc = [], []
        for i in np.flatnonzero(size >= length):
            n = size[i] - self.short + 1
            p = np.add.outer(np.arange(-(-n // PERIOD)) * PERIOD, COVER).ravel()
            p = p[p < n]
            at.append(p + self.begin[i])
            doc.append(np.full(len(p), i))
        self.at = np.concatenate(at) if at else np.empty(0, np.int64)
        self.doc = np.concatenate(doc) if doc else np.empty(0, np.int64)
        self.rank = span_hashes(self.data, self.at, self.at + self.short, 41)

    def keep(self, mask: np.ndarray) -> None:
        self.at, self.doc, self.rank = self.at[mask], self.doc[mask], self.rank[mask]

    def contexts(self) -> np.ndarray:
        """Hashes of what surrounds the suffixes; sets their spans."""
        first = self.begin[self.doc]
        self.lo = np.maximum(self.at - (PERIOD - 1), first)
        self.hi = np.minimum(self.at + self.length, first + self.size[self.doc])
        h = span_hashes(self.data, self.lo, self.hi, 42)
        return mix(h ^ mix(((self.at - self.lo) * 65536 + (self.hi - self.at)).astype(np.uint64), 43), 44)

    def strings(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the strings around picked suffixes, each once, and hashes."""
        lo, n = self.lo[pick], np.minimum(self.at[pick], self.hi[pick] - self.length) - self.lo[pick] + 1
        lo, n = lo[n > 0], n[n > 0]
        step = np.ones(int(n.sum()), np.int64)
        if len(n):
            ends = np.cumsum(n)[:-1]
            step[0] = lo[0]
            step[ends] = lo[1:] - (lo[:-1] + n[:-1] - 1)
        at = np.unique(np.cumsum(step)) if len(n) else step
        return at, span_hashes(self.data, at, at + self.length, 45)


def local_repeats(h: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    _, inverse, n = np.unique(h, return_inverse=True, return_counts=True)
    return n[inverse] > 1


def _shared(t: pa.Table) -> pa.Table:
    """Tell blocks the hashes that other blocks have too."""
    h, _, block = open_bucket(t)
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = h[1:] == h[:-1]
    hit = same[1:] | same[:-1]
    return reply_rows(block[hit], h[hit])


def _emit_ranks(length: int, buckets: int):
    def run(t: pa.Table) -> pa.Table:
        block = Block(t)
        return counted_rows(block, *np.unique(Sample(block, length).rank, return_counts=True), buckets)
    return run


def _emit_contexts(length: int, buckets: int, rank_buckets: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        block = Block(docs)
        s = Sample(block, length)
        ranks, place = np.unique(s.rank, return_inverse=True)
        s.keep(codes_for(ranks, rank_buckets, told)[place] > 0)
        pairs = np.stack([s.rank, s.contexts()], 1)
        pairs, n = np.unique(pairs, axis=0, return_counts=True)
        out = np.empty(len(pairs), CONTEXT)
        out["c"], out["e"], out["m"] = pairs[:, 0], pairs[:, 1], n > 1
        got = list(deal(out["c"], buckets))
        return pa.table({"bucket": pa.array([b for b, _ in got], pa.int32()), "rank": pa.array([block.rank] * len(got), pa.int32()),
                         "block": pa.array([block.block] * len(got), pa.int32()),
                         "hashes": pa.array([out[at].tobytes() for _, at in got], pa.binary())})
    return run


def _judge_contexts(t: pa.Table) -> pa.Table:
    """Mark contexts that repeat, and one holder of each where a rank has several.
    A bucket is judged a slice of ranks at a time, so that only its contexts themselves are held whole."""
    parts = [np.frombuffer(x.as_buffer(), CONTEXT) for x in t.column("hashes")]
    block = np.repeat(t.column("block").to_numpy(), [len(p) for p in parts])
    x = np.concatenate(parts)
    slice_of = (x["c"] >> np.uint64(64 - SLICE_BITS)).astype(np.uint8)
    blocks, marked = [], []
    for k in range(1 << SLICE_BITS):
        at = np.flatnonzero(slice_of == k)
        if len(at):
            of_block, told = _judge_slice(x[at], block[at])
            blocks.append(of_block)
            marked.append(told)
    return reply_rows(np.concatenate(blocks), np.concatenate(marked))


def _judge_slice(x: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The marked contexts of some ranks, with their blocks."""
    order = np.lexsort((block, x["e"], x["c"]))
    x, block = x[order], block[order]
    new_c, new_e = np.ones(len(x), bool), np.ones(len(x), bool)
    new_c[1:] = x["c"][1:] != x["c"][:-1]
    new_e[1:] = new_c[1:] | (x["e"][1:] != x["e"][:-1])
    of_e, of_c = np.cumsum(new_e) - 1, np.cumsum(new_c) - 1
    often = (np.bincount(of_e) > 1) | (np.bincount(of_e, x["m"]) > 0)
    several = np.bincount(of_c, new_e) > 1
    x["m"] = REPEATED * often[of_e] + RESOLVE * (several[of_c] & new_e)
    hit = x["m"] > 0
    return block[hit], x[hit]


def _marks(s: Sample, reply: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Of every sampled suffix of the block: context repeated; to be resolved."""
    parts = [np.frombuffer(x, CONTEXT) for x in reply.column("hashes").to_pylist()]
    told = np.concatenate(parts) if parts else np.empty(0, CONTEXT)
    s.keep(is_in(s.rank, np.sort(told["c"])))
    e = s.contexts()
    key = mix(s.rank, 46) ^ e
    told_key = mix(told["c"], 46) ^ told["e"]
    order = np.argsort(told_key)
    told_key, mark = told_key[order], told["m"][order]
    at = np.minimum(np.searchsorted(told_key, key), max(len(told_key) - 1, 0))
    mark = np.where(told_key[at] == key, mark[at], 0) if len(told_key) else np.zeros(len(key), np.uint8)
    resolve = np.flatnonzero(mark & RESOLVE)
    _, first = np.unique(key[resolve], return_index=True)
    return (mark & REPEATED) > 0, np.sort(resolve[first])


def _emit_strings(length: int, buckets: int):
    def run(docs: pa.Table, marks: pa.Table) -> pa.Table:
        block = Block(docs)
        s = Sample(block, length)
        _, resolve = _marks(s, marks)
        return hash_rows(block, np.unique(s.strings(resolve)[1]), buckets)
    return run


def _remove(length: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        block = Block(docs)
        s = Sample(block, length)
        is_mark = told.column("kind").to_numpy() == 1
        marks, reply = told.filter(pa.array(is_mark)), told.filter(pa.array(~is_mark))
        repeated, resolve = _marks(s, marks)
        at, h = s.strings(resolve)
        hit = is_in(h, read_reply(reply)) | local_repeats(h)
        whole = repeated & (s.hi - s.lo >= length)
        mask = covered(np.concatenate([s.lo[whole], at[hit]]), np.concatenate([s.hi[whole], at[hit] + length]), int(s.size.sum()))
        n_gone, spans, kept = [], [], []
        for i, text in enumerate(block.texts):
            cut = mask[s.begin[i]:s.begin[i] + s.size[i]]
            a, b = runs(cut)
            n_gone.append(int((b - a).sum()))
            spans.append([{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist())])
            kept.append(b"".join(text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)])) if len(a) else text)
        return pa.table({"doc_id": block.doc_id, "n_bytes": pa.array(s.size), "n_removed": pa.array(n_gone, pa.int64()),
                         "spans": pa.array(spans, SPANS), "kept": pa.array(kept, pa.binary())})
    return run


def suffix_dedup(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, spans of removed bytes, kept bytes."""
    if length < 2 * PERIOD:
        raise ValueError(f"length must be at least {2 * PERIOD}")
    blocks, total = make_blocks(id_text(docs, doc_id, text))
    sampled = total * len(COVER) / PERIOD
    by_block = lambda: blocks.groupBy("block")
    rank_buckets = buckets_for(sampled)
    ranks = by_block().applyInArrow(lean(_emit_ranks(length, rank_buckets)), HASHES)
    told = ranks.groupBy("bucket").applyInArrow(lean(frequencies), FREQUENCIES)
    # a context is twice a hash's bytes
    contexts = by_block().cogroup(told.groupBy("block")).applyInArrow(lean(_emit_contexts(length, buckets_for(sampled), rank_buckets)), HASHES)
    # read twice below: written once
    marks = materialize(contexts.groupBy("bucket").applyInArrow(lean(_judge_contexts), REPLY), "suffix-marks")
    strings = by_block().cogroup(marks.groupBy("block")).applyInArrow(lean(_emit_strings(length, buckets_for(sampled))), HASHES)
    found = strings.groupBy("bucket").applyInArrow(lean(_shared), REPLY)
    told = marks.withColumn("kind", F.lit(1)).unionByName(found.withColumn("kind", F.lit(2)))
    return by_block().cogroup(told.groupBy("block")).applyInArrow(lean(_remove(length)), RESULT)
