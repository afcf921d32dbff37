"""Line dedup (operator 6): repeated runs of lines.

``line_run_dedup`` (the query) compares every window of 2 consecutive lines, so
every run of 2 or more lines that stands earlier, by doc_id and place, is removed
whole, wherever it begins and ends.  The first occurrence of every line stays; a run's
first occurrence loses only lines that end or begin an earlier run.  Blocks exchange the windows' hashes; each then sends
one window of every text whose hash another block has too, with its bytes, and
is told which of them stand in an earlier block.  Spark compares them by hash and
bytes, one row per block and text; within a block their bytes are compared too.

``line_dedup`` compares content-defined chunks only: most of a short repeated run
stays.  A document is cut into lines at newlines.  A rolling hash over the hashes of 2
consecutive lines decides where a chunk ends (1 of 4 places, from 2 lines on; at
the latest after 16), so the same run of lines is cut alike wherever it
stands, a few lines after its beginning.  Chunks of 2 lines or more are
compared over all documents: the first occurrence, by doc_id and place, stays, and
every later one of the same bytes is removed.

Blocks exchange chunk hashes as in the other operators, and then send the bytes of
chunks whose hash occurs more than once; Spark groups them by hash and bytes, so
chunks of equal hash and different bytes stay apart, and a chunk that a third of the
documents share is one row per map task in that grouping.  The removals go back to the blocks.

Defined results: null or empty text is one empty line and loses nothing; windows and chunks
of white space alone stay; documents of equal doc_ids are ordered by a hash of their
texts, null doc_ids are largest; repeated rows lose
their repeated lines; a text that loses all is empty; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.blocks import (HASHES, REPLY, SEGMENT, Block, buckets_for, hash_rows, is_in, make_blocks, powers, prefix_sums,
                               read_reply, runs, spans_hash)
from strata.llm.suffixes import _shared, local_repeats
from strata.llm.substring import SPANS
from strata.llm.tables import id_text
from strata.llm.token_store import mix

ROLL, ONE_IN, LEAST, MOST = 2, 4, 2, 16
#: lines are rarely shorter than this on average: only sizes the buckets
LINE_BYTES = 40
RESULT = "doc_id long, n_lines long, n_removed long, spans array<struct<start:int,end:int>>, kept_text string"
WINDOWS = "hash long, body binary, doc_id long, salt long, window int, block int"
CHUNKS = "hash long, body binary, doc_id long, salt long, doc int, chunk int, block int"


def line_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and Rabin-Karp hashes of the lines of a text."""
    data = np.frombuffer(text, np.uint8)
    cut = np.flatnonzero(data == 10)
    start, end = np.append(0, cut + 1), np.append(cut, len(data))
    return start, end, mix(spans_hash(prefix_sums(data), start, end) + (end - start).astype(np.uint64), 61)


def chunk_ends(h: np.ndarray) -> list[int]:
    """One past the last line of every chunk."""
    roll = h.copy()
    for j in range(1, ROLL):
        roll[j:] += mix(h[:-j], 62 + j) if len(h) > j else 0
    wanted = mix(roll, 65) % np.uint64(ONE_IN) == 0
    out, last = [], 0
    for i in np.flatnonzero(wanted).tolist():
        while i + 1 - last > MOST:
            last += MOST
            out.append(last)
        if i + 1 - last >= LEAST:
            last = i + 1
            out.append(last)
    while len(h) - last > MOST:
        last += MOST
        out.append(last)
    if last < len(h):
        out.append(len(h))
    return out


class Chunks:
    """All chunks of a block: document, lines, bytes, hash, whether comparable."""

    def __init__(self, block: Block):
        doc, number, first, last, lo, hi, hashes = [], [], [], [], [], [], []
        self.lines = []
        for d, text in enumerate(block.texts):
            start, end, h = line_hashes(text)
            self.lines.append(len(h))
            ends = chunk_ends(h)
            a = 0
            p = powers(0xD1342543DE82EF95, len(h))
            for c, b in enumerate(ends):
                doc.append(d), number.append(c), first.append(a), last.append(b), lo.append(start[a]), hi.append(end[b - 1])
                hashes.append((h[a:b] * p[:b - a]).sum(dtype=np.uint64))
                a = b
        self.doc, self.number = np.array(doc, np.int32), np.array(number, np.int32)
        self.first, self.last = np.array(first, np.int64), np.array(last, np.int64)
        self.lo, self.hi = np.array(lo, np.int64), np.array(hi, np.int64)
        self.hash = mix(np.array(hashes, np.uint64), 66)
        body = [block.texts[d][a:b] for d, a, b in zip(doc, lo, hi)]
        self.usable = np.array([b - a >= LEAST and bool(t.strip()) for a, b, t in zip(first, last, body)], bool)
        self.body = body


def _emit(buckets: int):
    def run(t: pa.Table) -> pa.Table:
        block = Block(t)
        c = Chunks(block)
        return hash_rows(block, np.unique(c.hash[c.usable]), buckets)
    return run


def _repeated(docs: pa.Table, reply: pa.Table) -> pa.Table:
    block = Block(docs)
    c = Chunks(block)
    at = np.flatnonzero(c.usable)
    at = at[is_in(c.hash[at], read_reply(reply)) | local_repeats(c.hash[at])]
    pick = [c.doc[i] for i in at]
    return pa.table({"hash": pa.array(c.hash[at].view(np.int64)), "body": pa.array([c.body[i] for i in at], pa.binary()),
                     "doc_id": block.doc_id.take(pa.array(pick, pa.int32())), "salt": pa.array(block.salt[pick] if pick else [], pa.int64()),
                     "doc": pa.array(pick, pa.int32()), "chunk": pa.array(c.number[at]),
                     "block": pa.array([block.block] * len(at), pa.int32())})


def _remove(docs: pa.Table, gone: pa.Table) -> pa.Table:
    block = Block(docs)
    c = Chunks(block)
    out_of = set(zip(gone.column("doc").to_pylist(), gone.column("chunk").to_pylist()))
    kept: list[list[bytes]] = [[] for _ in block.texts]
    spans: list[list[dict]] = [[] for _ in block.texts]
    n_gone = np.zeros(len(block.texts), np.int64)
    for d, number, a, b, body in zip(c.doc.tolist(), c.number.tolist(), c.first.tolist(), c.last.tolist(), c.body):
        if (d, number) not in out_of:
            kept[d].append(body)
            continue
        n_gone[d] += b - a
        if spans[d] and spans[d][-1]["end"] == a:
            spans[d][-1]["end"] = b
        else:
            spans[d].append({"start": a, "end": b})
    return pa.table({"doc_id": block.doc_id, "n_lines": pa.array(c.lines, pa.int64()), "n_removed": pa.array(n_gone),
                     "spans": pa.array(spans, SPANS),
                     "kept_text": pa.array([b"\n".join(k) for k in kept], pa.binary()).cast(pa.string())})


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, spans of removed lines, and
    kept_text, the lines that stay."""
    blocks, total = make_blocks(id_text(docs, doc_id, text))
    hashes = blocks.groupBy("block").applyInArrow(_emit(buckets_for(total / LINE_BYTES / LEAST)), HASHES)
    shared = hashes.groupBy("bucket").applyInArrow(_shared, REPLY)
    found = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_repeated, CHUNKS)
    place = F.struct(F.isnull("doc_id").alias("null"), "doc_id", "salt", "block", "doc", "chunk")
    first = found.groupBy("hash", "body").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    later = (
        found.join(first, ["hash", "body"]).filter(place != F.col("_first"))
        .select("block", "doc", "chunk")
    )
    return blocks.groupBy("block").cogroup(later.groupBy("block")).applyInArrow(_remove, RESULT)


class Windows:
    """All windows of ``LEAST`` lines of a block that are not white space alone."""

    def __init__(self, block: Block):
        self.text = b"".join(t + b"\n" for t in block.texts)
        data = np.frombuffer(self.text, np.uint8)
        self.end = np.flatnonzero(data == 10)
        self.start = np.append(0, self.end + 1)[:-1]
        #: first line of every document, and one past the last
        self.first = np.searchsorted(self.start, np.cumsum([0] + [len(t) + 1 for t in block.texts]))
        doc = np.repeat(np.arange(len(block.texts)), np.diff(self.first))
        line = np.empty(len(self.start), np.uint64)
        a = 0
        while a < len(line):
            lo = self.start[a]
            b = max(a + 1, int(np.searchsorted(self.end, lo + SEGMENT, "right")))
            line[a:b] = spans_hash(prefix_sums(data[lo:self.end[b - 1]]), self.start[a:b] - lo, self.end[a:b] - lo)
            a = b
        line = mix(line + (self.end - self.start).astype(np.uint64), 61)
        ink = np.append(0, np.cumsum(~np.isin(data, np.frombuffer(b" \t\n\r\x0b\f", np.uint8))))
        n = max(len(line) - LEAST + 1, 0)
        h = line[:n].copy()
        for j in range(1, LEAST):
            h = mix(h, 66 + j) + line[j:j + n]
        #: first lines of the windows, ascending by (document, place)
        self.at = np.flatnonzero((doc[:n] == doc[LEAST - 1:][:n]) & (ink[self.end[LEAST - 1:][:n]] > ink[self.start[:n]]))
        self.hash, self.doc = mix(h[self.at], 66), doc[self.at]

    def body(self, i: int) -> bytes:
        return self.text[self.start[self.at[i]]:self.end[self.at[i] + LEAST - 1]]

    def firsts(self) -> np.ndarray:
        """Of every window, the first one of the block with the same bytes."""
        _, first, inverse = np.unique(self.hash, return_index=True, return_inverse=True)
        out = first[inverse]
        odd: dict[bytes, int] = {}  # equal hash, other bytes
        for i in np.flatnonzero(out != np.arange(len(out))).tolist():
            body = self.body(i)
            if body != self.body(out[i]):
                out[i] = odd.setdefault(body, i)
        return out


def _emit_windows(buckets: int):
    def run(t: pa.Table) -> pa.Table:
        block = Block(t)
        return hash_rows(block, np.unique(Windows(block).hash), buckets)
    return run


def _shared_windows(docs: pa.Table, reply: pa.Table) -> pa.Table:
    block = Block(docs)
    w = Windows(block)
    at = np.flatnonzero((w.firsts() == np.arange(len(w.at))) & is_in(w.hash, read_reply(reply)))
    pick = w.doc[at]
    return pa.table({"hash": pa.array(w.hash[at].view(np.int64)), "body": pa.array([w.body(i) for i in at], pa.binary()),
                     "doc_id": block.doc_id.take(pa.array(pick)), "salt": pa.array(block.salt[pick], pa.int64()),
                     "window": pa.array(at, pa.int32()),
                     "block": pa.array([block.block] * len(at), pa.int32())})


def _remove_runs(docs: pa.Table, gone: pa.Table) -> pa.Table:
    block = Block(docs)
    w = Windows(block)
    first = w.firsts()
    later = first != np.arange(len(first))
    earlier_block = np.zeros(len(first), bool)
    earlier_block[gone.column("window").to_numpy()] = True
    at = w.at[later | earlier_block[first]]
    mask = np.zeros(len(w.start), bool)
    for j in range(LEAST):
        mask[at + j] = True
    n_gone, spans, kept = [], [], []
    for d, text in enumerate(block.texts):
        cut = mask[w.first[d]:w.first[d + 1]]
        if not cut.any():
            n_gone.append(0), spans.append([]), kept.append(text)
            continue
        a, b = runs(cut)
        n_gone.append(int((b - a).sum()))
        spans.append([{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist())])
        a, b = runs(~cut)
        kept.append(b"\n".join([w.text[x:y] for x, y in zip(w.start[a + w.first[d]].tolist(), w.end[b + w.first[d] - 1].tolist())]))
    return pa.table({"doc_id": block.doc_id, "n_lines": pa.array(np.diff(w.first), pa.int64()), "n_removed": pa.array(n_gone, pa.int64()),
                     "spans": pa.array(spans, SPANS), "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})


def line_run_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Like ``line_dedup``, and every repeated run of ``LEAST`` lines or more is removed whole."""
    blocks, total = make_blocks(id_text(docs, doc_id, text))
    hashes = blocks.groupBy("block").applyInArrow(_emit_windows(buckets_for(total / LINE_BYTES)), HASHES)
    shared = hashes.groupBy("bucket").applyInArrow(_shared, REPLY)
    found = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_shared_windows, WINDOWS)
    place = F.struct(F.isnull("doc_id").alias("null"), "doc_id", "salt", "block", "window")
    first = found.withColumn("_first", F.min(place).over(Window.partitionBy("hash", "body")))
    later = first.filter(F.col("block") != F.col("_first.block")).select("block", "window")
    return blocks.groupBy("block").cogroup(later.groupBy("block")).applyInArrow(_remove_runs, RESULT)
