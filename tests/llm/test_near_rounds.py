"""Rounds of the near-dedup after the first: only members with further candidates, no bucket opened twice for the same labels."""

import numpy as np

from strata.llm import minhash


def test_later_rounds_reuse_the_open_buckets(spark, monkeypatch):
    bands, per_band = minhash.BANDS, minhash.ROWS
    samples = np.arange(bands * per_band, dtype="<u2").tobytes()
    rows = []
    for i in range(12):
        vector = np.empty(2, minhash.VECTOR)
        own = min(i, 10)  # n10 and n11 are twins, all others have nothing in common
        vector["h"], vector["w"] = [2 * own, 2 * own + 1], 1
        rows.append((f"n{i:02d}", 0.0, 2.0, bytearray(vector.tobytes()), [0] + [1000 * b + i for b in range(1, bands)], bytearray(samples)))
    sketches = spark.createDataFrame(rows, minhash.SKETCH)
    written, real = [], minhash.materialize
    monkeypatch.setattr(minhash, "materialize", lambda df, name: (written.append(name), real(df, name))[1])
    links, label = minhash.near_links(sketches)
    # the twins are each other's last candidate, beyond the first round
    assert [tuple(r) for r in links.collect()] == [("n10", "n11")]
    found = dict(map(tuple, label.collect()))
    assert found["n10"] == found["n11"] and len(set(found.values())) == 11
    assert written.count("near-candidates") == 2
    assert written.count("near-open") == 1  # before: once a round
