"""Operator 12 against all pairs."""

import random
import re

import numpy as np
import pytest
from test_operators import ROWS, prose

from strata.llm import blocks, ngram_join
from strata.llm.graph import joined, settle, smallest
from strata.llm.ngram_join import jaccard_components, order_c, parity_map

SCHEMA = "node string, doc_id long, text string, n string, block int, label long, token string, component_id string, rest int"


def sets_of(texts):
    out = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
        out.append({tuple(w[i:i + 4]) for i in range(max(len(w) - 3, 1))} if w else set())
    return out


def plain(rows):
    """(doc_id, n_shingles, component_id) of all rows, from all pairs."""
    sets, root = sets_of([t for _, t in rows]), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(find(i), []).append(d)
    return [(d, len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame([("x", d, t, None, 3, 4, "t", None, 5) for d, t in rows], SCHEMA).repartition(4)


def check(spark, rows):
    got = jaccard_components(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain(rows)))
    return got


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 6000)
    monkeypatch.setattr(blocks, "BUCKET_HASHES", 900)
    monkeypatch.setattr(ngram_join, "CHUNK_OTHERS", 5)
    monkeypatch.setattr(ngram_join, "CHUNK_ALL", 7)
    monkeypatch.setattr(ngram_join, "FIRST_BEST", 1)


def test_shared_fixture(spark, small):
    got = check(spark, ROWS)
    assert {r["component_id"] for r in got if r["n_shingles"] == 0} >= {6, 7, 8, 9, None}  # each alone


def changed(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10 ** 6)}"
    return " ".join(words)


def test_families_at_the_threshold(spark, small):
    """Changed copies on both sides of the threshold, families that hang together by one
    member only, and a passage that dissimilar texts share."""
    rng = random.Random(12)
    rows, passage = [], prose(rng, 40)
    for f in range(12):
        base = prose(rng, rng.choice([8, 30, 80, 200])).split()
        for _ in range(9):
            rows.append((len(rows), changed(rng, base, rng.choice([0, 0, 1, 1, 2, 3, 5]))))
    base = prose(rng, 120).split()
    for _ in range(25):  # a chain: each changes the last one
        base = changed(rng, base, 1).split()
        rows.append((len(rows), " ".join(base)))
    for _ in range(30):
        rows.append((len(rows), prose(rng, 10) + " " + passage + " " + prose(rng, 5)))
    rng.shuffle(rows)
    got = check(spark, rows)
    assert 20 < len({r["component_id"] for r in got}) < len(rows) - 60


def test_exact_border(spark):
    """17 of 20 shingles shared is a link, 16.99 isn't."""
    w = [f"a{i}" for i in range(40)]
    rows = [(1, " ".join(w[:23])), (2, " ".join(w[:20])), (3, " ".join(w[:19])), (4, " ".join(w[:16]))]
    assert [len(s) for s in sets_of([t for _, t in rows])] == [20, 17, 16, 13]
    by = {r["doc_id"]: r["component_id"] for r in check(spark, rows)}
    assert by == {1: 1, 2: 1, 3: 1, 4: 4}  # 3 through 2; 13 of 16 is under


def test_half_of_the_rows_in_one_family(spark, small):
    rng = random.Random(4)
    base = prose(rng, 60).split()
    rows = [(i, changed(rng, base, 1)) for i in range(60)] + [(100 + i, " ".join(base)) for i in range(20)]
    rows += [(200 + i, prose(rng, 50)) for i in range(60)]
    rows += [(None, " ".join(base)), (None, prose(rng, 9)), (3, prose(rng, 9))]
    check(spark, rows)
    check(spark, [(1, " ".join(base)), (2, changed(rng, base, 1))])


def test_empty(spark):
    assert jaccard_components(frame(spark, [])).count() == 0
    check(spark, [(1, None), (2, ""), (3, " \n")])


def test_map_and_orders():
    rng = np.random.default_rng(1)
    s = np.unique(rng.integers(0, 1 << 63, 300).astype(np.uint64))
    bits = lambda x: np.unpackbits(np.frombuffer(parity_map(x), np.uint8))
    assert (bits(s) != bits(s[20:])).sum() <= 20
    assert len(np.unique(order_c(s))) == len(s) and (np.argsort(order_c(s)) != np.arange(len(s))).any()


def test_graph(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 20] + [(50, 60)], "a long, b long")
    got = {r["node"]: r["label"] for r in smallest(links).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{i: 21 for i in range(21, 41)}, 50: 50, 60: 50}
    label = settle(spark.createDataFrame([(i, max(i - 1, 0)) for i in range(30)] + [(70, 70)], "node long, label long"))
    assert {r["node"]: r["label"] for r in label.collect()} == {**{i: 0 for i in range(30)}, 70: 70}
    more = joined(label, spark.createDataFrame([(70, 5), (3, 4)], "a long, b long"))
    assert {r["label"] for r in more.collect()} == {0}
