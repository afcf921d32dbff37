"""Vector code compression (operator 11): product quantization in exact integers over
Hilbert-sorted flat blocks.

A vector's components become integers, floor(1024 x), and the vector is cut into 4 equal
consecutive parts.  Each part position has a codebook of 256 entries.  Four rounds assign every part to its
nearest entry and move each entry to the floor of its parts' mean; then parts are assigned once more.

1. The parts of a position are sorted along a Hilbert curve (range partitions of the
   curve's key; equal keys, such as copies, are spread by a hash of the row) and written, some hundred neighbours at a
   time, as flat blocks: the integers, the least box around them, and their sum.
2. A round reads the blocks.  Distances between a block's box and the entries bound
   the distance of every part in it: an entry whose nearest corner is farther than some other entry's
   farthest corner is nobody's nearest.  What remains is the block's shortlist.  With one
   entry on it, the block's sum goes to that entry as it is; else a kernel computes the exact distances
   to the shortlist.  A task sends one row per entry it has met, so a round shuffles entries, not vectors.
3. The kernel is a product of small integer matrices.  It runs in doubles
   where a bound from box and entries shows that every sum stays under 2^53, which makes it exact; else in
   Python's integers.

Sums travel as limbs of 40 bits, as many as the largest component needs, so they don't overflow.
Only codebooks (4 x 256 entries) and their sums reach the driver.

Defined results: rows whose vector is null, or holds a null, NaN or infinite component, are
dropped, and so are vectors that can't be cut like the rest: those whose length is not that of
the first kept vector, or no positive multiple of 4.  Seeds are taken in the order of vec_id (nulls last),
rows of one vec_id in the order of their components; with fewer than 256
vectors there are as many entries.  Rows that repeat are coded each.  An error beyond 64 bits is null.  An empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.packing import hilbert_key
from strata.llm.tables import ship_package
from strata.session import materialize

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
BLOCK = 128
RANGE_VECTORS = 1 << 17
LIMB = 40
EXACT = 1 << 53
BLOCKS = "part int, n int, rids binary, ids array<long>, labels array<string>, data binary, low binary, high binary, total binary"
SUMS = "part int, entry int, n long, sums array<long>"
CODES = "rid long, part int, entry int, distance decimal(38,0), vec_id long, label string"


# ---------------------------------------------------------------- integers
def usable(vector: Column) -> Column:
    """Vectors without null, NaN and infinite components."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(fine(x), F.lit(False))), F.lit(False))


def whole(x: np.ndarray) -> np.ndarray:
    """floor(1024 x) as doubles: a double times a power of two is exact, and so is its floor."""
    with np.errstate(over="ignore"):
        out = np.floor(x * float(SCALE))
    return np.where(np.isfinite(out), out, x * 1.0)  # beyond 2^1014 only; integers already


def held_as(reach: float) -> str:
    """The smallest number type that holds all integers up to ``reach``."""
    return "<i2" if reach < 1 << 15 else "<i4" if reach < 1 << 31 else "<f8"


def integers(x: np.ndarray) -> np.ndarray:
    """Doubles that hold integers, as Python's integers."""
    out = np.empty(x.shape, object)
    out.ravel()[:] = [int(v) for v in x.ravel()]
    return out


def limbs_of(v: int, n: int) -> list[int]:
    """v as n numbers of 40 bits, the lowest first; the last one keeps the sign."""
    out = []
    for _ in range(n - 1):
        out.append(v & (1 << LIMB) - 1)
        v >>= LIMB
    return out + [v]


def from_limbs(x: list[int]) -> int:
    return sum(int(v) << LIMB * i for i, v in enumerate(x))


# ------------------------------------------------------------------ blocks
def _curve_bits(dims: int) -> int:
    return max(1, min(8, 62 // dims))


def _keys(reach: float, dims: int):
    """Rows of parts with their place on the curve.  Beyond 62 dimensions the first 62 make the key."""
    def run(batches):
        for b in batches:
            x = np.stack(b.column("vector").to_numpy(zero_copy_only=False)).astype(np.float64) if b.num_rows else np.empty((0, dims * PARTS))
            x = whole(x)
            bits = _curve_bits(dims)
            keys, data = [], []
            for p in range(PARTS):
                part = np.ascontiguousarray(x[:, p * dims:(p + 1) * dims])
                cell = np.clip(((part[:, :62] + reach) / (2 * reach + 1) * (1 << bits)).astype(np.int64), 0, (1 << bits) - 1)
                keys.append(hilbert_key(cell, bits).astype(np.int64))
                data += [row.tobytes() for row in part.astype(held_as(reach))]
            n = b.num_rows
            yield pa.record_batch({
                "part": pa.array(np.repeat(np.arange(PARTS, dtype=np.int32), n)), "key": pa.array(np.concatenate(keys)),
                "rid": pa.concat_arrays([b.column("rid")] * PARTS), "data": pa.array(data, pa.binary()),
                # id and label travel with the first part
                **{c: pa.concat_arrays([b.column(c), pa.nulls(n * (PARTS - 1), b.column(c).type)]) for c in ("vec_id", "label")}})
    return run


def _blocks(dims: int, size: int, held: str):
    """Flat blocks of neighbours, from rows that come in the order of (part, key)."""
    def made(t: pa.Table):
        part = t.column("part").to_numpy()
        x = np.frombuffer(b"".join(t.column("data").to_pylist()), held).reshape(-1, dims).astype(np.float64)
        out = []
        for run in np.split(np.arange(len(part)), np.flatnonzero(np.diff(part)) + 1):
            for lo in range(0, len(run), size):
                at = slice(int(run[lo]), int(run[min(lo + size, len(run)) - 1]) + 1)
                d = x[at]
                total = [int(v) for v in d.sum(0)] if np.abs(d).sum(0).max() < EXACT else [sum(map(int, c)) for c in d.T]
                out.append((int(part[at.start]), len(d), t.column("rid").to_numpy()[at].tobytes(), t.column("vec_id")[at].to_pylist(),
                            t.column("label")[at].to_pylist(), d.astype(held).tobytes(), d.min(0).tobytes(), d.max(0).tobytes(),
                            b",".join(str(v).encode() for v in total)))
        names = [f.split()[0] for f in BLOCKS.split(", ")]
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.string()), *[pa.binary()] * 4)
        return pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names)

    def run(batches):
        waiting = []
        for b in batches:
            waiting.append(b)
            if sum(x.num_rows for x in waiting) >= size * 64:
                yield made(pa.Table.from_batches(waiting))
                waiting = []
        if sum(x.num_rows for x in waiting):
            yield made(pa.Table.from_batches(waiting))
    return run


# -------------------------------------------------------------- assignment
def shortlists(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """(blocks, entries): may the entry be the nearest of a part in the box?  In doubles, with room for
    their rounding, so no entry is left out wrongly; entries that tie stay."""
    c = book[None]
    nearest = np.square(np.maximum(np.maximum(low[:, None] - c, c - high[:, None]), 0)).sum(2)
    farthest = np.square(np.maximum(np.abs(c - low[:, None]), np.abs(c - high[:, None]))).sum(2)
    return nearest * (1 - 1e-9) <= farthest.min(1)[:, None] * (1 + 1e-9)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of every row (the lowest of those that tie) and the
    squared distance, exactly."""
    reach = float(max(np.abs(x).max(), np.abs(book).max())) if x.size else 0.0
    if 4 * reach * reach * max(1, x.shape[1]) < EXACT:
        d = np.square(x).sum(1)[:, None] - 2 * (x @ book.T) + np.square(book).sum(1)[None]
        best = d.argmin(1)
        return best, d[np.arange(len(x)), best].astype(np.int64)
    xi, bi = integers(x), integers(book)
    best, dist = [], []
    for row in xi:
        d = [int(sum((row - e) ** 2)) for e in bi]
        dist.append(min(d))
        best.append(d.index(dist[-1]))
    return np.array(best), np.array(dist, object)


def _opened(batches, books: dict, dims: int, held: str):
    """Blocks with their shortlists: (part, block row, data, entries on the list)."""
    for b in batches:
        part = b.column("part").to_numpy()
        box = [np.frombuffer(b"".join(b.column(c).to_pylist()), np.float64).reshape(-1, dims) for c in ("low", "high")]
        for lo in range(0, b.num_rows, 64):
            here = np.arange(lo, min(lo + 64, b.num_rows))
            for p in np.unique(part[here]).tolist():
                at = here[part[here] == p]
                for i, fits in zip(at.tolist(), shortlists(box[0][at], box[1][at], books[p])):
                    x = np.frombuffer(b.column("data")[i].as_buffer(), held).reshape(-1, dims).astype(np.float64)
                    yield p, b, i, x, np.flatnonzero(fits)


def _round(books: dict, dims: int, limbs: int, held: str):
    """Sums of the parts of every entry, over all blocks of a task."""
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    def run(batches):
        sums: dict = {}

        def add(p, e, n, total):
            have = sums.get((p, e))
            sums[p, e] = (n, total) if have is None else (have[0] + n, [a + b for a, b in zip(have[1], total)])

        for p, b, i, x, on_list in _opened(batches, books, dims, held):
            if len(on_list) == 1:
                add(p, int(on_list[0]), len(x), [int(v) for v in b.column("total")[i].as_py().split(b",")])
                continue
            entry = on_list[nearest(x, books[p][on_list])[0]]
            order = np.argsort(entry, kind="stable")
            starts = np.flatnonzero(np.diff(entry[order], prepend=-1))
            if np.abs(x).sum(0).max() < EXACT:
                totals = np.add.reduceat(x[order], starts).astype(np.int64).tolist()
            else:
                totals = np.add.reduceat(integers(x[order]), starts).tolist()
            for a, n, total in zip(starts, np.diff(np.append(starts, len(x))).tolist(), totals):
                add(p, int(entry[order[a]]), n, total)
        rows = [(p, e, n, [v for t in total for v in limbs_of(t, limbs)]) for (p, e), (n, total) in sums.items()]
        yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)] if rows else
                              [pa.array([], f.type) for f in schema], schema=schema)
    return run


def _assign(books: dict, dims: int, held: str):
    from decimal import Decimal

    def run(batches):
        for p, b, i, x, on_list in _opened(batches, books, dims, held):
            best, dist = nearest(x, books[p][on_list])
            rid = np.frombuffer(b.column("rids")[i].as_buffer(), np.int64)
            n = len(rid)
            dist = [Decimal(int(v)) if int(v) < 10 ** 38 else None for v in dist]
            yield pa.record_batch({
                "rid": pa.array(rid), "part": pa.array(np.full(n, p, np.int32)), "entry": pa.array(on_list[best].astype(np.int32)),
                "distance": pa.array(dist, pa.decimal128(38, 0)), "vec_id": b.column("ids")[i].values,
                "label": b.column("labels")[i].values})
    return run


def _book(ints: list[list[int]]) -> np.ndarray:
    return np.array([[float(v) for v in e] for e in ints], np.float64)


def vector_codes(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                 rounds: int = ROUNDS, entries: int = ENTRIES, block: int = BLOCK) -> tuple[DataFrame, dict[int, list[list[int]]]]:
    """(codes, codebooks): per kept row vec_id, label, codes (array of the parts' entries) and
    error; for each part position its entries as integers."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("vector"))
    kind = dict(rows.dtypes)["label"]
    rows = rows.filter(usable(F.col("vector")) & (F.size("vector") > 0) & (F.size("vector") % PARTS == 0))
    order = [F.asc_nulls_last("vec_id"), F.asc("vector")]
    # the seeds and the first vector's length: at most 256 rows
    lead = rows.orderBy(*order).select(F.size("vector")).first()
    width = lead[0] if lead else PARTS
    dims = width // PARTS
    rows = rows.filter(F.size("vector") == width)
    seeds = [r[0] for r in rows.orderBy(*order).limit(entries).select("vector").collect()]
    seeds = whole(np.array(seeds, np.float64).reshape(-1, width))
    reach = rows.agg(F.max(F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector")))), F.count(F.lit(1))).first()
    top = float(whole(np.array([reach[0] or 0.0]))[0]) + 1
    held = held_as(top)
    limbs = 1 + int(np.ceil((np.log2(top) + 1) / LIMB))
    books = {p: [[int(v) for v in e] for e in seeds[:, p * dims:(p + 1) * dims]] for p in range(PARTS)}
    parts = rows.withColumn("label", F.col("label").cast("string")).withColumn("rid", F.monotonically_increasing_id()).mapInArrow(
        _keys(top, dims), "part int, key long, rid long, data binary, vec_id long, label string")
    n = max(1, -(-PARTS * reach[1] // RANGE_VECTORS))
    spread = F.xxhash64("rid")
    sorted_ = parts.repartitionByRange(max(n, PARTS), "part", "key", spread).sortWithinPartitions("part", "key", spread)
    blocks = materialize(sorted_.mapInArrow(_blocks(dims, block, held), BLOCKS), "vector-blocks")
    for _ in range(rounds):
        floats = {p: _book(b) for p, b in books.items()}
        met = blocks.select("part", "data", "low", "high", "total").mapInArrow(_round(floats, dims, limbs, held), SUMS)
        summed = met.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[
            F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dims * limbs)]).collect()  # at most 4 x 256 rows
        for r in summed:
            total = [from_limbs([r[f"s{d * limbs + i}"] for i in range(limbs)]) for d in range(dims)]
            books[r["part"]][r["entry"]] = [t // r["n"] for t in total]
    floats = {p: _book(b) for p, b in books.items()}
    assigned = blocks.select("part", "data", "low", "high", "rids", "ids", "labels").mapInArrow(_assign(floats, dims, held), CODES)
    at = lambda p: F.max(F.when(F.col("part") == p, F.col("entry")))
    # the sum over parts is null where a part's distance is
    codes = assigned.groupBy("rid").agg(
        F.max("vec_id").alias("vec_id"), F.max("label").alias("label"), F.array(*[at(p) for p in range(PARTS)]).alias("codes"),
        F.when(F.count("distance") == PARTS, F.sum("distance")).alias("error"))
    return materialize(codes.select("vec_id", F.col("label").cast(kind).alias("label"), "codes",
                                    F.expr("try_cast(error AS long)").alias("error")), "vector-codes"), books


def codebooks_sha256(books: dict[int, list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(v) for p in sorted(books) for e in books[p] for v in e).encode()).hexdigest()


def decode(codes: list[int], books: dict[int, list[list[int]]]) -> list[float]:
    """The vector that a code stands for."""
    return [v / SCALE for p, c in enumerate(codes) for v in books[p][c]]


def label_errors(codes: DataFrame) -> DataFrame:
    """The codes with label_error: error summed over equal labels, nulls together."""
    total = codes.groupBy("label").agg(F.expr("try_sum(error)").alias("label_error"))
    named = total.select(F.col("label").alias("_label"), "label_error")
    return codes.join(named, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
