"""Packing (operator 5): sequences along a space-filling curve.

A document becomes the hashed vector of its token ids: every id has a fixed
seeded random direction in 4 dimensions, and the directions of its distinct ids
are summed, weighted by log(1 + count).  Each dimension is cut into 256 levels by the
normal distribution, and the cell's place on the Hilbert curve is the key:
documents with similar content get neighbouring keys.  Documents are put in order of the key (ties,
such as copies, by a hash of the id; rows that repeat a key in whole ranges are dealt to all of those), laid end to end and cut every 2048 ids.  So every
sequence is full but the very last one, and sequences hold neighbours.

Ids are encoded once and written to the checkpoint folder; ranges of the key
are cut by quantiles; one number per range (its ids) gives every range its
first place, so ranges are packed independently.

Defined results: null text is empty (a document of the end id alone); null
doc_ids are packed like others; wholly repeated rows are packed each; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.ranges import cut_points, range_of
from strata.llm.tables import id_text, release, ship_package
from strata.llm.token_store import mix, pack_ids, unpack_ids
from strata.llm.tokens import encoder, lots
from strata.session import scratch_path

LENGTH = 2048
DIMS, BITS = 4, 8
RANGE_IDS = 3 << 20
PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer cells (rows), by transposing the
    coordinates level by level and undoing the curve's turns and mirrors."""
    x = [cells[:, d].astype(np.uint64) for d in range(cells.shape[1])]
    one = np.uint64(1)
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        p = q - one
        for d in range(len(x)):
            set_ = (x[d] & q) > 0
            t = np.where(set_, np.uint64(0), (x[0] ^ x[d]) & p)
            x[0] = np.where(set_, x[0] ^ p, x[0] ^ t)
            if d:
                x[d] = x[d] ^ t
        q >>= one
    for d in range(1, len(x)):
        x[d] = x[d] ^ x[d - 1]
    t = np.zeros(len(cells), np.uint64)
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        t = np.where((x[-1] & q) > 0, t ^ (q - one), t)
        q >>= one
    x = [c ^ t for c in x]
    key = np.zeros(len(cells), np.uint64)
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = (key << one) | ((c >> np.uint64(b)) & one)
    return key


def directions(ids: np.ndarray, dims: int = DIMS, seed: int = 11) -> np.ndarray:
    """A fixed random direction per id: uniform numbers of unit variance, hashed from the id."""
    h = np.stack([mix(ids.astype(np.uint64), seed + d) >> np.uint64(11) for d in range(dims)], 1)
    return (h.astype(np.float64) / 2.0 ** 53 - 0.5) * sqrt(12)


_TABLE = [np.empty((0, DIMS))]


def known_directions(ids: np.ndarray) -> np.ndarray:
    """``directions`` from a table that covers the ids seen so far."""
    if len(ids) and int(ids.max()) >= len(_TABLE[0]):
        _TABLE[0] = directions(np.arange(max(65536, int(ids.max()) + 1), dtype=np.uint64))
    return _TABLE[0][ids]


def curve_cell(ids: np.ndarray) -> list[int]:
    """Cell of a document: directions of its distinct ids, weighted by log(1 + count), scaled to unit variance."""
    ids, n = np.unique(ids, return_counts=True)
    w = np.log1p(n)
    z = w @ known_directions(ids) / sqrt((w * w).sum())
    return [min(int((1 + erf(a / 2 / sqrt(2))) / 2 * (1 << BITS)), (1 << BITS) - 1) for a in z]


def _encode(path: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        enc, seen = encoder(path), 0
        for b in batches:
            for a, n in lots(b.column("text")):
                doc = b.column("doc_id").slice(a, n)
                raw = [x + end for x in enc.encode(b.column("text").slice(a, n).to_pylist())]
                cells = np.array([curve_cell(np.frombuffer(x, "<u4")) for x in raw]).reshape(-1, DIMS)
                tie = np.array([zlib.crc32(str(d).encode()) for d in doc.to_pylist()], np.uint64)
                key = (hilbert_key(cells) << np.uint64(31)) | (tie >> np.uint64(1))
                # rows of one key are told apart by their number, so they can be dealt to several ranges
                salt, seen = np.arange(seen, seen + len(raw)), seen + len(raw)
                yield pa.record_batch({"doc_id": doc, "key": pa.array(key.astype(np.int64)), "salt": pa.array(salt),
                                       "n": pa.array([len(x) // 4 for x in raw], pa.int64()),
                                       "packed": pa.array([pack_ids(x) for x in raw], pa.binary())})
        release()
    return run


def _deal(cuts: np.ndarray):
    def run(batches):
        for b in batches:
            key = b.column("key").to_numpy()
            part, _ = range_of(key, np.zeros(len(key), bool), mix(b.column("salt").to_numpy().view(np.uint64), 12), cuts)
            yield pa.record_batch([pa.array(part, pa.int32()), *b.columns], ["part", *b.schema.names])
    return run


def _cut(base: np.ndarray, length: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("key", "ascending"), ("doc_id", "ascending"), ("packed", "ascending")])
        at = int(base[t.column("part")[0].as_py()])
        out = []
        for doc, n, packed in zip(t.column("doc_id").to_pylist(), t.column("n").to_pylist(), t.column("packed").to_pylist()):
            ids, start = unpack_ids(packed).tobytes(), 0
            while start < n:
                take = min(n - start, length - at % length)
                out.append((doc, start, take, ids[4 * start:4 * (start + take)], n, at // length, at % length))
                start, at = start + take, at + take
        return pa.table(list(map(pa.array, zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()))),
                        [f.split()[0] for f in PIECE.split(", ")])
    return run


def pack_sequences(docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, doc_id: str = "doc_id",
                   text: str = "text", range_ids: int = RANGE_IDS) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (little-endian
    unsigned 32-bit), doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    ship_package(spark)
    path = scratch_path(spark, "packing")
    schema = "doc_id long, key long, salt long, n long, packed binary"
    id_text(docs, doc_id, text).mapInArrow(_encode(tokenizer, end_id), schema).write.option("compression", "none").parquet(path)
    coded = spark.read.schema(schema).parquet(path)
    total = coded.agg(F.sum("n")).first()[0] or 0
    cuts = cut_points(coded, "key", max(1, -(-total // range_ids)))
    dealt = coded.mapInArrow(_deal(cuts), "part int, " + schema)
    ids = np.zeros(len(cuts) + 1, np.int64)
    for part, n in coded.select("key", "salt", "n").mapInArrow(_deal(cuts), "part int, key long, salt long, n long").groupBy("part").agg(F.sum("n")).collect():
        ids[part] = n  # one number per range
    return dealt.groupBy("part").applyInArrow(_cut(np.cumsum(ids) - ids, length), PIECE)
