"""Memory of one bucket of contexts (operator 7), and the marks it gives."""

import tracemalloc

import numpy as np
import pyarrow as pa

from strata.llm.suffixes import CONTEXT, REPEATED, RESOLVE, _judge_contexts

BLOCKS, EACH = 40, 5000


def bucket():
    rng = np.random.default_rng(5)
    blobs, x = [], None
    for k in range(BLOCKS):
        last, x = x, np.zeros(EACH, CONTEXT)
        x["c"], x["e"] = rng.integers(0, 1 << 63, EACH, np.uint64) * np.uint64(2), rng.integers(0, 1 << 63, EACH, np.uint64)
        if last is not None:
            x["c"][:100] = last["c"][100:200]
            x["e"][:50] = last["e"][100:150]
        blobs.append(x.tobytes())
    return pa.table({"bucket": pa.array([0] * BLOCKS, pa.int32()), "rank": pa.array([0] * BLOCKS, pa.int32()),
                     "block": pa.array(range(BLOCKS), pa.int32()), "hashes": pa.array(blobs, pa.binary())})


def test_a_bucket_takes_little_beside_its_contexts():
    t = bucket()
    _judge_contexts(t)
    tracemalloc.start()
    _judge_contexts(t)
    peak = tracemalloc.get_traced_memory()[1] / (BLOCKS * EACH)
    tracemalloc.stop()
    assert peak < 50, f"{peak:.0f} bytes for each context"


def test_marks_of_shared_ranks():
    t = bucket()
    held = {}
    for block, blob in zip(t.column("block").to_pylist(), t.column("hashes").to_pylist()):
        for c, e, _ in np.frombuffer(blob, CONTEXT).tolist():
            held.setdefault(c, {}).setdefault(e, []).append(block)
    want = set()
    for c, by_context in held.items():
        for e, blocks in by_context.items():
            for i, b in enumerate(sorted(blocks)):
                m = REPEATED * (len(blocks) > 1) + RESOLVE * (len(by_context) > 1 and i == 0)
                if m:
                    want.add((b, c, e, m))
    got = _judge_contexts(t)
    assert want == {(b, c, e, m) for b, blob in zip(got.column("block").to_pylist(), got.column("hashes").to_pylist())
                    for c, e, m in np.frombuffer(blob, CONTEXT).tolist()}
