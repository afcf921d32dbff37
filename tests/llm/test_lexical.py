"""Operator 13 against a plain scoring of all documents."""

import math
import random
from collections import Counter

import brute
import pytest
from test_operators import ITEMS, ROWS, prose

from strata.llm import lexical
from strata.llm.lexical import automaton, contributions, search, term_counts

SCHEMA = "item int, doc_id long, text string, score string, n int, terms string, term string, rank long, item_id string"


def plain(rows, items, top=50):
    docs = [Counter(brute.bench_words(t)) for _, t in rows]
    n = [sum(c.values()) for c in docs]
    count, length = sum(x > 0 for x in n), sum(n)
    df = Counter(t for c in docs for t in c)
    terms = {}
    for i, t in items:
        terms.setdefault(i, set()).update(brute.bench_words(t))
    out = []
    for item, ts in terms.items():
        found = []
        for (d, _), c, k in zip(rows, docs, n):
            s = 0
            for t in ts & c.keys():
                w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                s += w * (1000000000 * c[t] // (1000 * c[t] + 20 * (50 + 50 * k * count // length)))
            if s > 0:
                found.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(found)[:top])]
    return out


def check(spark, rows, items, **kw):
    docs = spark.createDataFrame([(1, d, t, "s", 2, "x", None, 3, "i") for d, t in rows], SCHEMA).repartition(3)
    bench = spark.createDataFrame([(i, t, 5, "a", 7) for i, t in items], "item_id long, text string, term int, items string, doc_id long")
    out = search(docs, bench, **kw)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    got = sorted(map(repr, map(tuple, out.collect())))
    assert got == sorted(map(repr, plain(rows, items, kw.get("top", 50))))
    return got


@pytest.mark.parametrize("term_bytes", [1 << 20, 60])
def test_shared_fixture(spark, monkeypatch, term_bytes):
    monkeypatch.setattr(lexical, "SCORES", 20)
    assert check(spark, ROWS, ITEMS, top=4, term_bytes=term_bytes)


def test_ranks_of_a_larger_corpus(spark):
    """Words in all documents, ties, repeated rows, and more results than are wanted."""
    rng = random.Random(2)
    common = prose(rng, 12).split()
    rows = [(i, " ".join(rng.choice(common + ["x1", "X1", "é", "12"]) for _ in range(rng.randint(1, 40)))) for i in range(150)]
    rows += [(i % 7, "tie tie word") for i in range(80)] + [(None, "tie word"), (5, None), (6, "!!")]
    items = [(i, " ".join(rng.sample(common, 4)) + " tie") for i in range(6)] + [(3, "word X1"), (None, "É é word"), (9, None), (8, "zzz")]
    got = check(spark, rows, items)
    assert len(got) > 300


def test_empty_tables(spark):
    check(spark, [], ITEMS)
    check(spark, ROWS, [])
    check(spark, [(1, None), (2, " ,")], [(1, "a b")])


def test_boundaries():
    found = automaton(["a", "ab", "b", "é", "1", "aé"])
    n, tf = term_counts("A ab,ab.b\x00a_a é Éa aé 1a 1  1".encode(), found)
    assert n == 12 and tf == {0: 3, 1: 2, 2: 1, 3: 1, 5: 1, 4: 1}
    assert term_counts(b"", found) == (0, Counter())


def test_no_overflow():
    import numpy as np

    weight, tf, n = np.array([7]), np.array([3]), np.array([1 << 40])
    want = 7 * (10 ** 9 * 3 // (3000 + 20 * (50 + 50 * (1 << 40) * (1 << 30) // (1 << 50))))
    assert contributions(weight, tf, n, 1 << 30, 1 << 50).tolist() == [want]
