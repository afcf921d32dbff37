"""Document frequencies of hashes over blocks, in few bytes.

A block deals its distinct hashes to hash buckets and sends each bucket 32 bits of every hash, ascending, as
differences, with the number of its documents that have it.  A bucket adds up equal values and answers each block with one byte per
hash, in the order they were sent, so nothing has to be named twice.  Buckets hold about as many hashes whatever the corpus, so
the chance that two different hashes of a bucket agree in 32 bits stays near one in two thousand.  Such a pair
looks more frequent than it is, never less: what has a frequency of 1 is in one document alone.

The byte is ``CODE`` steps for each doubling of the frequency (0: one document; 255: over two million), a function
of the hash alone, so every block ranks and weighs a hash the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from strata.llm.blocks import Block, deal

CODE = 12
FREQUENCIES = "block int, bucket int, codes binary"


def squeeze(x: np.ndarray) -> bytes:
    """32-bit numbers by byte planes, compressed."""
    planes = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unsqueeze(b: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(b, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel()


def _dealt(h: np.ndarray, buckets: int):
    """(bucket, places, their 32 bits ascending): the order in which a block sends its distinct hashes."""
    for bucket, at in deal(h, buckets):
        low = (h[at] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        order = np.argsort(low, kind="stable")
        yield bucket, at[order], low[order]


def counted_rows(block: Block, h: np.ndarray, n: np.ndarray, buckets: int) -> pa.Table:
    """The block's distinct hashes with the number of its documents that have them (in the form of ``HASHES``)."""
    numbers, blobs = [], []
    for bucket, at, low in _dealt(h, buckets):
        steps = squeeze(np.diff(low, prepend=np.uint32(0)))
        numbers.append(bucket)
        blobs.append(len(at).to_bytes(4, "little") + len(steps).to_bytes(4, "little") + steps + squeeze(n[at]))
    return pa.table({"bucket": pa.array(numbers, pa.int32()), "rank": pa.array([0] * len(numbers), pa.int32()),
                     "block": pa.array([block.block] * len(numbers), pa.int32()), "hashes": pa.array(blobs, pa.binary())})


def code_of(df: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(CODE * np.log2(df)), 255).astype(np.uint8)


def frequency_of(code: np.ndarray) -> np.ndarray:
    return 2.0 ** (code / CODE)


def frequencies(t: pa.Table) -> pa.Table:
    """One bucket: the code of every hash that was sent, for each block."""
    lows, counts = [], []
    for blob in t.column("hashes").to_pylist():
        n, size = int.from_bytes(blob[:4], "little"), int.from_bytes(blob[4:8], "little")
        lows.append(np.cumsum(unsqueeze(blob[8:8 + size], n), dtype=np.uint32))
        counts.append(unsqueeze(blob[8 + size:], n))
    low, count = np.concatenate(lows), np.concatenate(counts)
    order = np.argsort(low, kind="stable")
    new = np.ones(len(low), bool)
    new[1:] = low[order][1:] != low[order][:-1]
    start = np.flatnonzero(new)
    df = np.empty(len(low), np.int64)
    df[order] = np.repeat(np.add.reduceat(count[order].astype(np.int64), start), np.diff(np.append(start, len(low))))
    parts = np.split(code_of(df), np.cumsum([len(x) for x in lows])[:-1])
    return pa.table({"block": t.column("block"), "bucket": t.column("bucket"),
                     "codes": pa.array([len(p).to_bytes(4, "little") + pa.compress(p.tobytes(), codec="zstd", asbytes=True) for p in parts], pa.binary())})


def codes_for(h: np.ndarray, buckets: int, told: pa.Table) -> np.ndarray:
    """The codes of a block's distinct hashes, given as they were sent."""
    answers = {}
    for bucket, blob in zip(told.column("bucket").to_pylist(), told.column("codes").to_pylist()):
        answers[bucket] = np.frombuffer(pa.decompress(
            blob[4:], decompressed_size=int.from_bytes(blob[:4], "little"), codec="zstd", asbytes=True), np.uint8)
    out = np.empty(len(h), np.uint8)
    for bucket, at, _ in _dealt(h, buckets):
        out[at] = answers[bucket]
    return out
