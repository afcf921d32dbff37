"""Documents in blocks, hashes of their words, and hash exchange between blocks.

A block is a range of doc_ids of about ``BLOCK_BYTES`` of text.  Blocks travel
compressed, so a shuffle of all texts costs a fraction of their bytes.  An
operator that compares windows of all documents sends, for every block, the
distinct window hashes to hash buckets (sorted arrays, not one row per window),
judges one bucket at a time, and sends each block the hashes that matter to it.
A hash that occurs in a third of all documents is one entry per block.

Memory: a task holds one block (or one document, if that is longer) or one
bucket.  Both counts follow the input's bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.ranges import cut_points, range_of
from strata.llm.tables import ship_package, text_bytes
from strata.llm.token_store import mix

BLOCK_BYTES = 4 << 20
BUCKET_HASHES = 2 << 20
BLOCKS = "block int, rank int, docs binary"
HASHES = "bucket int, rank int, block int, hashes binary"
REPLY = "block int, hashes binary"


# ------------------------------------------------------------------ blocks
def _pack(cuts: np.ndarray, null_ranges: int):
    def run(batches):
        from strata.llm.tables import trim
        from strata.llm.tokens import forget

        forget()  # a reused worker may still hold an encoder's pieces
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for b in batches:
            null = np.array(b.column("doc_id").is_null())
            key = b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            salt = b.column("salt").to_numpy(zero_copy_only=False)
            block, rank = range_of(key, null, mix(salt.view(np.uint64), 5), cuts, null_ranges)
            order = np.argsort(block, kind="stable")
            edges = np.flatnonzero(np.diff(block[order])) + 1
            for at in np.split(order, edges) if len(order) else ():
                part = b.take(pa.array(at))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=options) as w:
                    w.write_batch(part)
                yield pa.record_batch({"block": pa.array([block[at[0]]], pa.int32()), "rank": pa.array([rank[at[0]]], pa.int32()),
                                       "docs": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
        trim()  # the worker stays for tasks to come
    return run


def make_blocks(rows: DataFrame) -> tuple[DataFrame, int]:
    """Blocks of (doc_id, text), kept on the executors' disks for the passes to
    come (a lost one is made again), and the number of text bytes."""
    ship_package(rows.sparkSession)
    total = text_bytes(rows)
    n = max(1, -(-total // BLOCK_BYTES))
    packed = rows.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("salt")).mapInArrow(
        _pack(cut_points(rows, "doc_id", n), n), BLOCKS)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return packed.repartition(max(1, min(n, parts)), "block").persist(StorageLevel.DISK_ONLY), total


class Block:
    """One block, opened: documents ascending by (null last, doc_id), those of one
    id by a hash of their text, so every pass sees the same order."""

    def __init__(self, t: pa.Table):
        parts = [pa.ipc.open_stream(x.as_buffer()).read_all() for x in t.column("docs")]
        docs = pa.concat_tables(parts).sort_by([("doc_id", "ascending"), ("salt", "ascending")]) if parts else None
        self.block = t.column("block")[0].as_py() if t.num_rows else None
        self.rank = t.column("rank")[0].as_py() if t.num_rows else None
        self.doc_id = docs.column("doc_id").combine_chunks() if parts else pa.array([], pa.int64())
        self.texts = [x or b"" for x in docs.column("text").to_pylist()] if parts else []
        self.salt = docs.column("salt").to_numpy() if parts else np.empty(0, np.int64)
        null = np.array(self.doc_id.is_null())
        key = self.doc_id.fill_null(0).to_numpy(zero_copy_only=False)
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (null[1:] != null[:-1])
        #: equal for equal doc_ids; null doc_ids are one class, the last
        self.order = np.cumsum(new) - 1


# ------------------------------------------------------------------ hashes
_BYTE = mix(np.arange(256, dtype=np.uint64), 21)
_BASE = 0xD1342543DE82EF95
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BASE_2 = 0x9E6C63D0876A9A47
SEGMENT = 1 << 18
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n, modulo 2 ** 64."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        p = np.full(max(n, SEGMENT * 2) + 1, base, np.uint64)
        p[0] = 1
        _POWERS[base] = have = np.multiply.accumulate(p)
    return have


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """S with S[i] = sum over j < i of value(data[j]) * base ** j."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(_BYTE[data] * powers(_BASE, len(data))[:len(data)], out=out[1:])
    return out


def spans_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rabin-Karp hashes of the byte spans [start, end) under ``prefix_sums``."""
    return (sums[end] - sums[start]) * powers(_BASE_INV, len(sums))[start]


class Words:
    """Words of all documents of a block: where they are, and their hashes."""

    def __init__(self, texts: list[bytes], is_word: np.ndarray, fold: np.ndarray | None = None):
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)  # a space is no word in any of the classes used
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        flag = np.empty(len(data) + 1, np.int8)
        flag[0] = 0
        flag[1:] = is_word[data]
        step = np.diff(flag)
        self.start = np.flatnonzero(step == 1)
        self.end = np.flatnonzero(step == -1)
        self.doc = np.searchsorted(starts, self.start, "right") - 1
        #: first word of every document, and one past the last
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1), "left")
        self.data, self.starts = data, starts
        out = np.empty(len(self.start), np.uint64)
        a = 0
        while a < len(out):
            lo = self.start[a]
            b = max(a + 1, int(np.searchsorted(self.end, lo + SEGMENT, "right")))
            piece = data[lo:self.end[b - 1]]
            sums = prefix_sums(piece if fold is None else fold[piece])
            out[a:b] = spans_hash(sums, self.start[a:b] - lo, self.end[a:b] - lo)
            a = b
        self.hash = mix(out + (self.end - self.start).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25), 22)

    def second(self, k: int, at: np.ndarray) -> np.ndarray:
        """Hashes of the windows that start at the words ``at``, independent of those of ``windows``."""
        if not len(at):
            return np.empty(0, np.uint64)
        words = mix(self.hash, 71)
        h = words[at].copy()
        for j in range(1, k):
            h *= np.uint64(_BASE_2)
            h += words[at + j]
        return mix(h, 72)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of k words within one document, and their
        Rabin-Karp hashes over the word hashes."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        h = self.hash[:n].copy()
        for j in range(1, k):
            h *= np.uint64(_BASE)
            h += self.hash[j:j + n]
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1:k - 1 + n])
        return at, mix(h[at], 23)


# ---------------------------------------------------------------- exchange
def buckets_for(count: float) -> int:
    return max(1, int(-(-count // BUCKET_HASHES)))


def deal(hashes: np.ndarray, buckets: int):
    """(bucket, indices), bucket by bucket."""
    if not len(hashes):
        return
    b = (mix(hashes, 31) >> np.uint64(20)) % np.uint64(buckets)
    order = np.argsort(b, kind="stable")
    edges = np.flatnonzero(np.diff(b[order])) + 1
    for at in np.split(order, edges):
        yield int(b[at[0]]), at


def hash_rows(block: Block, hashes: np.ndarray, buckets: int) -> pa.Table:
    got = list(deal(hashes, buckets))
    return pa.table({"bucket": pa.array([b for b, _ in got], pa.int32()),
                     "rank": pa.array([block.rank] * len(got), pa.int32()),
                     "block": pa.array([block.block] * len(got), pa.int32()),
                     "hashes": pa.array([hashes[at].tobytes() for _, at in got], pa.binary())})


def open_bucket(t: pa.Table, dtype="<u8") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a bucket with their ranks and blocks, ascending by (hash, rank)."""
    t = t.sort_by([("rank", "ascending"), ("block", "ascending")])
    parts = [np.frombuffer(x, dtype) for x in t.column("hashes").to_pylist()]
    n = [len(p) for p in parts]
    h = np.concatenate(parts)
    order = np.argsort(h, kind="stable")
    return h[order], np.repeat(t.column("rank").to_numpy(), n)[order], np.repeat(t.column("block").to_numpy(), n)[order]


def reply_rows(block: np.ndarray, hashes: np.ndarray) -> pa.Table:
    """Hashes for each block, one row per block."""
    order = np.argsort(block, kind="stable")
    edges = np.flatnonzero(np.diff(block[order])) + 1
    parts = np.split(order, edges) if len(order) else []
    return pa.table({"block": pa.array([block[at[0]] for at in parts], pa.int32()),
                     "hashes": pa.array([hashes[at].tobytes() for at in parts], pa.binary())})


def read_reply(t: pa.Table, dtype="<u8") -> np.ndarray:
    """All hashes of a block's replies, ascending."""
    parts = [np.frombuffer(x, dtype) for x in t.column("hashes").to_pylist()]
    return np.sort(np.concatenate(parts)) if parts else np.empty(0, dtype)


def is_in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in the ascending table."""
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return table[at] == values


def pair_groups(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number for every pair (a, b): equal for equal pairs."""
    order = np.lexsort((b, a))
    new = np.ones(len(a), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    out = np.empty(len(a), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def covered(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in any [start, end)."""
    return np.cumsum(np.bincount(start, minlength=n + 1) - np.bincount(end, minlength=n + 1))[:n] > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of True: starts and ends."""
    step = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)
