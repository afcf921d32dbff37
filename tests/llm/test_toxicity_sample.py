"""The training sample when a doc_id repeats."""

from __future__ import annotations

import random

from test_operators import prose

from strata.llm import toxicity
from strata.llm.toxicity import score_toxicity

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"


def make():
    rng = random.Random(41)
    rows = [(i, prose(rng, 20) + (" insult" if i % 5 == 0 else " plain")) for i in range(300)]
    return rng, rows, [(i, 0, int(i % 5 == 0)) for i in range(300)]


def scores(spark, rows, labels, **fit):
    d, lab = spark.createDataFrame(rows, DOCS).repartition(5), spark.createDataFrame(labels, LABELS)
    return {r["doc_id"]: r["score"] for r in score_toxicity(d, lab, bits=14, **fit).collect()}


def test_copies_of_a_row_change_no_score(spark):
    _, rows, labels = make()
    alone = scores(spark, rows, labels)
    for i in (0, 3, 7, 10):
        assert scores(spark, rows + [rows[i]] * 150, labels) == alone


def test_sample_is_bounded_by_max_rows(spark, monkeypatch):
    rng, rows, labels = make()
    rows += [(i, prose(rng, 20)) for i in (0, 3, 5, 7, 10) for _ in range(100)]
    seen, fit = [], toxicity.FactorizationMachine.fit
    monkeypatch.setattr(toxicity.FactorizationMachine, "fit", lambda self, rows, y, **k: seen.append(len(rows)) or fit(self, rows, y, **k))
    first = scores(spark, rows, labels, max_rows=300)
    rng.shuffle(rows)
    again = scores(spark, rows, labels, max_rows=300)
    n = sum(not h for h in held(spark, range(300)))
    assert seen == [n, n] and first.keys() == again.keys()
    assert scores(spark, rows, labels, max_rows=60) and seen[-1] == 60


def held(spark, ids):
    d = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    return [r[0] for r in d.select(toxicity.held_out(d["doc_id"])).collect()]
