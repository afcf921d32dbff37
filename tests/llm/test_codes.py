"""Operator 11 against a plain version in Python's integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.codes import (codebooks_sha256, decode, from_limbs, label_errors, limbs_of, nearest, shortlists, vector_codes, whole)

SCHEMA = "part int, key long, vec_id long, embedding array<float>, label int, rid string, n string, error double"


def plain(rows, entries=256, rounds=4):
    """rows: (vec_id, vector, label) -> ({row place: (codes, error)}, codebooks)."""
    def fine(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    kept = [i for i, (_, v, _) in enumerate(rows) if fine(v) and len(v) and len(v) % 4 == 0]
    kept.sort(key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))
    kept = [i for i in kept if len(rows[i][1]) == len(rows[kept[0]][1])]
    ints = {i: [math.floor(1024 * x) for x in rows[i][1]] for i in kept}
    d = len(ints[kept[0]]) // 4 if kept else 0
    books = [[ints[i][p * d:(p + 1) * d] for i in kept[:entries]] for p in range(4)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(4):
            got = {}
            for i in kept:
                x = ints[i][p * d:(p + 1) * d]
                got.setdefault(near(p, x)[1], []).append(x)
            for k, xs in got.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    out = {}
    for i in kept:
        best = [near(p, ints[i][p * d:(p + 1) * d]) for p in range(4)]
        out[i] = ([k for _, k in best], sum(e for e, _ in best))
    return out, dict(enumerate(books))


def f32(v):
    return [float(np.float32(x)) for x in v]


def vectors(n, dims, seed, scale=1.0):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, scale) for _ in range(dims)] for _ in range(6)]
    return [f32(c + rng.gauss(0, scale / 5) for c in rng.choice(centre)) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(1, 2, i, v, lab, "r", None, 0.5) for i, v, lab in rows], SCHEMA).repartition(3)


def check(spark, rows, **kw):
    codes, books = vector_codes(frame(spark, rows), **kw)
    want, plain_books = plain(rows, kw.get("entries", 256), kw.get("rounds", 4))
    big = 1 << 63
    assert books == plain_books and codebooks_sha256(books) == codebooks_sha256(plain_books)
    key = lambda r: tuple((x is None, x if x is not None else 0) if not isinstance(x, list) else x for x in r)
    assert sorted(((r["vec_id"], r["label"], r["codes"], r["error"]) for r in codes.collect()), key=key) == sorted(
        ((rows[i][0], rows[i][2], c, e if e < big else None) for i, (c, e) in want.items()), key=key)
    return codes, books


def cases():
    hot = vectors(1, 8, 2)[0]
    rows = [(i, v, i % 3 if i % 7 else None) for i, v in enumerate(vectors(90, 8, 1))]
    rows += [(200 + i, hot, 1) for i in range(60)]  # one vector in a third of the rows
    rows += [(5, rows[6][1], 2), (5, rows[5][1], 5 % 3), (None, hot, None), (None, rows[0][1], 0)]
    # not usable: null vector, null, NaN and infinite components, other lengths
    bad = [None, hot[:7] + [None], hot[:7] + [float("nan")], hot[:7] + [float("inf")], [], hot[:6], hot[:4]]
    return rows + [(500 + i, v, 3) for i, v in enumerate(bad)]


@pytest.mark.parametrize("entries", [256, 12])
def test_equals_plain_version(spark, entries):
    codes, books = check(spark, cases(), entries=entries, block=16)
    assert codes.count() == 154 and len(books[0]) == min(entries, 154)
    error = {r["label"]: r for r in label_errors(codes).groupBy("label").agg(
        F.sum("error").alias("s"), F.max("label_error").alias("hi"), F.min("label_error").alias("lo")).collect()}
    assert set(error) == {None, 0, 1, 2} and all(r["s"] == r["hi"] == r["lo"] for r in error.values())


def test_large_and_small_components(spark):
    """Components beyond 2^53, negative and denormal ones, and ties between entries."""
    rows = [(i, f32(v), 0) for i, v in enumerate(vectors(40, 4, 3, 1e12))]
    rows += [(100, f32([3e38, -3e38, 1e-45, -1e-45]), 1), (101, f32([3e38, -3e38, 0.0, -0.0]), 1), (102, [0.5, -0.5, 0.0, 2.0], 0)]
    codes, _ = check(spark, rows, entries=5, block=8)
    assert codes.filter("error is null").count() >= 1
    assert {r["label_error"] for r in label_errors(codes.filter("error is null")).collect()} == {None}


def test_wide_parts_and_one_vector(spark):
    check(spark, [(i, v, 0) for i, v in enumerate(vectors(30, 4 * 70, 4))], entries=4, rounds=2, block=8)
    check(spark, [(7, [0.25, 1.0, -1.0, 3.0], None)])


def test_empty_tables(spark):
    for rows in ([], [(1, None, 0), (2, [float("nan")] * 4, 1), (3, [], 1)]):
        codes, books = vector_codes(frame(spark, rows))
        assert codes.count() == 0 and label_errors(codes).count() == 0 and books == {p: [] for p in range(4)}


def test_shortlist_keeps_the_nearest():
    rng = np.random.default_rng(1)
    left_out = 0
    for _ in range(60):
        x = rng.integers(-300, 300, (1, 4)) + rng.integers(-40, 40, (16, 4)).astype(float)
        book = rng.integers(-400, 400, (50, 4)).astype(float)
        fits = shortlists(x.min(0)[None], x.max(0)[None], book)[0]
        best, dist = nearest(x, book)
        assert fits[best].all()
        again, same = nearest(x, book[fits])
        assert (np.flatnonzero(fits)[again] == best).all() and (same == dist).all()
        left_out += (~fits).sum()
    assert left_out > 1000


def test_small_parts():
    assert all(from_limbs(limbs_of(v, 4)) == v for v in (0, -1, 1, 1 << 100, -(1 << 100) - 7, (1 << 40) - 1))
    assert whole(np.array([-0.0001, 0.9999, -1.0])).tolist() == [-1.0, 1023.0, -1024.0]
    assert nearest(np.zeros((1, 2)), np.array([[1.0, 0], [0, 1.0], [-1.0, 0]]))[0].tolist() == [0]
    assert decode([0, 0, 1, 0], {p: [[1024, 512], [2048, 0]] for p in range(4)}) == [1.0, 0.5, 1.0, 0.5, 2.0, 0.0, 1.0, 0.5]
