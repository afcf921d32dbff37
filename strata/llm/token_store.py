"""Token-id output (operator 4): raw id payloads with a minimal perfect hash index.

The store is a Parquet table with one row per shard, written by Spark's
committed writer (a lost executor's attempt leaves nothing behind):

    shard      ascending; documents lie in ascending doc_id order over the shards
    tokens     ids in the payload
    keys       doc_id and occurrence of the shard's documents in order (int64 pairs)
    null_keys  how many of them, at the end, have a null doc_id
    payload    the ids of all documents, little-endian unsigned 32-bit, end ids included
    levels     minimal perfect hash: bits of each level, rank gives the slot
    prints     32-bit fingerprint per slot
    offsets    first id and number of ids per slot (int64 pairs)

A key (doc_id, occurrence) is hashed with one seed per level; keys that are alone
on their bit end there, the others go on to the next level; a key's slot is the
number of set bits before its own.  So an access costs a bounded number of
probes, and the fingerprint rejects (all but 2^-32 of) keys that aren't there.

Shards are ranges of doc_id cut by quantiles.  Memory is bounded by a shard
(``SHARD_BYTES`` of text, or one document).

Defined results: null text is empty (one end id); rows that repeat a doc_id are
occurrences 0, 1, ... in order of their ids' bytes; null doc_ids come last; an
empty table gives an empty store; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.ranges import cut_points, range_of
from strata.llm.tables import id_text, ship_package, text_bytes
from strata.llm.tokens import encoder, lots

SHARD_BYTES = 8 << 20
STORE = ("shard int, tokens long, keys binary, null_keys long, payload binary, "
         "levels array<binary>, prints binary, offsets binary")


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """splitmix64 finalizer."""
    x = x.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(doc_id: np.ndarray, occurrence: np.ndarray, null: np.ndarray) -> np.ndarray:
    return mix(mix(doc_id.astype(np.int64).view(np.uint64), 1) ^ mix(occurrence.astype(np.uint64), 2), 3 + 0) ^ null.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit hashes: levels of bit arrays."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = np.cumsum([0] + [int(b.sum()) for b in levels])
        self.ranks = [np.cumsum(b) - b for b in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        levels, left = [], keys
        while len(left):
            size = max(8, -(-len(left) * 3 // 2 // 8) * 8)
            at = mix(left, 100 + len(levels)) % np.uint64(size)
            bits = np.bincount(at.astype(np.int64), minlength=size) == 1
            levels.append(bits)
            left = left[~bits[at.astype(np.int64)]]
        return cls(levels)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """Slots; -1 where no level has a bit."""
        out = np.full(len(keys), -1, np.int64)
        for i, bits in enumerate(self.levels):
            at = (mix(keys, 100 + i) % np.uint64(len(bits))).astype(np.int64)
            hit = (out < 0) & bits[at]
            out[hit] = self.before[i] + self.ranks[i][at[hit]]
        return out

    def dump(self) -> list[bytes]:
        return [np.packbits(b).tobytes() for b in self.levels]

    @classmethod
    def load(cls, dumped: list[bytes]) -> "PerfectHash":
        return cls([np.unpackbits(np.frombuffer(b, np.uint8)).astype(bool) for b in dumped])


def pack_ids(ids: bytes, squeeze: bool = True) -> bytes:
    """For the shuffle: 16-bit where that's enough, compressed unless Spark's own compression is to do."""
    a = np.frombuffer(ids, "<u4")
    narrow = not len(a) or a.max() < 1 << 16
    raw = a.astype("<u2").tobytes() if narrow else ids
    if not squeeze:
        return (b"n" if narrow else b"w") + raw
    return (b"2" if narrow else b"4") + zstandard.compress(raw, 1)


def unpack_ids(blob: bytes) -> np.ndarray:
    kind = blob[:1]
    raw = blob[1:] if kind in b"nw" else zstandard.decompress(blob[1:])
    return np.frombuffer(raw, "<u2" if kind in b"2n" else "<u4").astype("<u4")


def encode_batches(path: str, end_id: int, cuts: np.ndarray, null_ranges: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        enc = encoder(path)
        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text")
            null = np.array(ids.is_null())
            key = ids.fill_null(0).to_numpy(zero_copy_only=False)
            for a, n in lots(texts):
                raw = [x + end for x in enc.encode(texts.slice(a, n).to_pylist())]
                salt = np.array([len(x) * 2654435761 + int.from_bytes(x[:8], "little") & (1 << 63) - 1 for x in raw], np.uint64)
                shard, _ = range_of(key[a:a + n], null[a:a + n], mix(salt, 0), cuts, null_ranges)
                yield pa.record_batch({"doc_id": ids.slice(a, n), "shard": pa.array(shard, pa.int32()),
                                       "packed": pa.array([pack_ids(x, squeeze=False) for x in raw], pa.binary())})
    return run


def write_shard(t: pa.Table) -> pa.Table:
    """All documents of one shard, put in order, as one row of the store."""
    doc, packed = t.column("doc_id").to_pylist(), t.column("packed").to_pylist()
    order = sorted(range(len(doc)), key=lambda i: (doc[i] is None, doc[i] or 0, packed[i]))
    null = np.array([doc[i] is None for i in order])
    key = np.array([doc[i] or 0 for i in order], np.int64)
    new = np.ones(len(order), bool)
    new[1:] = (key[1:] != key[:-1]) | (null[1:] != null[:-1])
    occurrence = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    ids = [unpack_ids(packed[i]) for i in order]
    length = np.array([len(x) for x in ids], np.int64)
    h = key_hash(key, occurrence, null)
    mph = PerfectHash.build(h)
    slot = mph.slot(h)
    prints, offsets = np.empty(len(h), "<u4"), np.empty((len(h), 2), "<i8")
    prints[slot] = mix(h, 50) >> np.uint64(32)
    offsets[slot] = np.stack([np.cumsum(length) - length, length], 1)
    return pa.table({
        "shard": pa.array([t.column("shard")[0].as_py()], pa.int32()), "tokens": [int(length.sum())],
        "keys": pa.array([np.stack([key, occurrence], 1).astype("<i8").tobytes()], pa.binary()),
        "null_keys": [int(null.sum())], "payload": pa.array([np.concatenate(ids).tobytes()], pa.binary()),
        "levels": pa.array([mph.dump()], pa.list_(pa.binary())), "prints": pa.array([prints.tobytes()], pa.binary()),
        "offsets": pa.array([offsets.tobytes()], pa.binary())})


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id",
                 text: str = "text", shard_bytes: int = SHARD_BYTES) -> None:
    """Encode every whole text and write the store to ``path``."""
    ship_package(docs.sparkSession)
    rows = id_text(docs, doc_id, text)
    shards = max(1, -(-text_bytes(rows) // shard_bytes))
    run = encode_batches(tokenizer, end_id, cut_points(rows, "doc_id", shards), shards)
    coded = rows.mapInArrow(run, "doc_id long, shard int, packed binary")
    coded.groupBy("shard").applyInArrow(write_shard, STORE).write.option("compression", "zstd").parquet(path)


class Shard:
    """Keyed access to one row of the store."""

    def __init__(self, row: dict):
        self.mph = PerfectHash.load(row["levels"])
        self.prints = np.frombuffer(row["prints"], "<u4")
        self.offsets = np.frombuffer(row["offsets"], "<i8").reshape(-1, 2)
        self.payload = row["payload"]

    def find(self, key: np.ndarray, occurrence: np.ndarray, null: np.ndarray) -> np.ndarray:
        """(first id, number of ids) of each key; number -1 where absent."""
        h = key_hash(key, occurrence, null)
        slot = self.mph.slot(h)
        out = np.full((len(h), 2), -1, np.int64)
        ok = slot >= 0
        ok[ok] = self.prints[slot[ok]] == (mix(h[ok], 50) >> np.uint64(32)).astype(np.uint32)
        out[ok] = self.offsets[slot[ok]]
        return out


def _read(base: dict[int, int]):
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                shard = Shard(row)
                key = np.frombuffer(row["keys"], "<i8").reshape(-1, 2)
                null = np.zeros(len(key), bool)
                null[len(key) - row["null_keys"]:] = row["null_keys"] > 0
                at = shard.find(key[:, 0], key[:, 1], null)
                for a in range(0, len(key), 512):
                    part = at[a:a + 512]
                    yield pa.record_batch({
                        "doc_id": pa.array(key[a:a + 512, 0], mask=null[a:a + 512]),
                        "start": pa.array(part[:, 0] + base[row["shard"]]),
                        "ids": pa.array([row["payload"][4 * s:4 * (s + n)] for s, n in part.tolist()], pa.binary())})
    return run


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a store through its index: doc_id, start (ids of all
    documents before it), ids (little-endian unsigned 32-bit)."""
    ship_package(spark)
    store = spark.read.schema(STORE).parquet(path)
    base, at = {}, 0
    for shard, n in sorted(store.select("shard", "tokens").collect()):  # one number per shard
        base[shard], at = at, at + n
    return store.mapInArrow(_read(base), "doc_id long, start long, ids binary")


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """doc_id, ids of the wanted doc_ids (first occurrences) that the store has.
    Keys are dealt to shards by their key ranges, then found by the index."""
    store = spark.read.schema(STORE).parquet(path)

    def span(batches):
        for b in batches:
            for r in b.to_pylist():
                key = np.frombuffer(r["keys"], "<i8").reshape(-1, 2)[:, 0]
                key = key[:len(key) - r["null_keys"]]
                if len(key):
                    yield pa.record_batch({"shard": pa.array([r["shard"]], pa.int32()), "lo": [int(key[0])], "hi": [int(key[-1])]})

    spans = store.select("shard", "keys", "null_keys").mapInArrow(span, "shard int, lo long, hi long").orderBy("lo", "shard").toArrow()
    lo, shard = spans.column("lo").to_numpy(), spans.column("shard").to_numpy()

    def route(batches):
        for b in batches:
            key = b.column("doc_id").drop_null().to_numpy(zero_copy_only=False)
            at = np.searchsorted(lo, key, "right") - 1
            # an id spread over several shards: its first occurrences are in each of them; take the first
            at = np.where(at >= 0, np.searchsorted(lo, lo[np.maximum(at, 0)], "left"), -1) if len(lo) else np.full(len(key), -1)
            yield pa.record_batch({"doc_id": pa.array(key[at >= 0]), "shard": pa.array(shard[at[at >= 0]], pa.int32())})

    def find(keys: pa.Table, rows: pa.Table) -> pa.Table:
        if not rows.num_rows or not keys.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "ids": pa.array([], pa.binary())})
        r = rows.to_pylist()[0]
        key = keys.column("doc_id").to_numpy()
        at = Shard(r).find(key, np.zeros(len(key), np.int64), np.zeros(len(key), bool))
        ok = at[:, 1] >= 0
        return pa.table({"doc_id": pa.array(key[ok]),
                         "ids": pa.array([r["payload"][4 * s:4 * (s + n)] for s, n in at[ok].tolist()], pa.binary())})

    keys = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().mapInArrow(route, "doc_id long, shard int")
    return keys.groupBy("shard").cogroup(store.groupBy("shard")).applyInArrow(find, "doc_id long, ids binary")
