"""Every pipeline stage on nulls in all columns, repeated rows, long texts, clashing columns and empty
tables; the whole against a brute-force run; the model's score against its sum over pairs."""

import random

import brute
import corpus_pipeline
import numpy as np
import pytest
from test_operators import ROWS, prose

from strata.llm.minhash import IS_WORD, shingles
from strata.llm.toxicity import FactorizationMachine

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, score double, _h string, label int, key long"


def table(spark, path, rows, labels=(), items=()):
    extra = [(d, t, None if i % 2 else "en", None, i if i % 3 else None, "n", 0.5, None, 1, 9) for i, (d, t) in enumerate(rows)]
    spark.createDataFrame(extra, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def through(spark, path):
    """doc_ids and texts after each stage."""
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, path)
        if name != "packing":
            assert got.columns == docs.columns
        got.write.parquet(f"{path}/out/{name}")
        docs = spark.read.parquet(f"{path}/out/{name}")
        out[name] = docs.collect()
    return out


def test_stages_on_edge_cases(spark, tmp_path):
    rng = random.Random(5)
    long = prose(rng, 30_000)
    rows = ROWS + [(50, long), (51, long + " end")] + [ROWS[3]] * 4 + [(None, None)] * 3
    table(spark, str(tmp_path), rows, [(None, None, None), (1, None, None)], [(1, None), (None, "")])
    out = through(spark, str(tmp_path))
    assert len(out["toxicity"]) == len(rows)  # nothing to learn from: nothing is rejected
    texts = {t or "" for _, t in rows}
    kept = [r["text"] or "" for r in out["exact_dedup"]]
    assert sorted(kept) == sorted(texts)
    near = {r["text"] or "" for r in out["minhash_near_dedup"]}
    assert near < texts and len(out["minhash_near_dedup"]) == len(near) and (long in near) != (long + " end" in near)
    assert len(out["benchmark_decontamination"]) == len(near)  # no usable item
    assert sum(r["start"] == 0 for r in out["packing"]) == len(near)


def test_stages_on_empty_tables(spark, tmp_path):
    table(spark, str(tmp_path), [])
    assert {name: len(rows) for name, rows in through(spark, str(tmp_path)).items()} == {name: 0 for name, _ in corpus_pipeline.STAGES}


def plain_pipeline(rows, insult, items):
    """doc_ids that stay: toxic ones by the planted word, equal texts by the largest id, near ones (plain Jaccard, far from the threshold)
    by the smallest, and benchmark windows."""
    rows = [(d, t) for d, t in rows if insult not in t.split()]
    last = {t: d for d, t in sorted(rows)}
    rows = sorted((d, t) for t, d in last.items())
    sets = []
    for _, t in rows:
        sets.append(set(shingles([t.encode()])[1].tolist()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            s = len(a & sets[j]) / max(1, len(a | sets[j]))
            assert s < 0.7 or s > 0.85  # clear cases
            if s > 0.8:
                a_, b_ = find(i), find(j)
                root[max(a_, b_)] = min(a_, b_)
    rows = [r for i, r in enumerate(rows) if find(i) == i]
    hit = {d for d, *_, bad in brute.op10(rows, items) if bad}
    return {d for d, _ in rows if d not in hit}


def test_whole_run_equals_brute_force(spark, tmp_path):
    rng = random.Random(77)
    rows, labels = [], []
    for i in range(150):
        words = prose(rng, 70).split()
        bad = i % 5 == 0
        rows.append((i, " ".join(words[:30] + (["vileslur"] if bad else []) + words[30:])))
        labels.append((i, 1, int(bad)))
    clean = [r for r in rows if r[0] % 5]
    passage = prose(rng, 25)
    for k in range(20):
        rows.append((1000 + k, clean[k][1]))  # copies
        near = clean[k + 20][1].split()
        near[33] = f"changed{k}"
        rows.append((2000 + k, " ".join(near)))
        rows.append((3000 + k, prose(rng, 15) + " " + " ".join(passage.split()[k % 5:k % 5 + 15]) + " " + prose(rng, 9)))
    items = [(1, passage), (2, "nothing like it " + prose(rng, 12))]
    table(spark, str(tmp_path), rows, labels, items)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} == plain_pipeline(rows, "vileslur", items)
    filled = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert IS_WORD[48] and all(n == 2048 for s, n in filled.items() if s != max(filled))


def test_score_is_the_sum_over_pairs():
    fm = FactorizationMachine(bits=6, factors=4)
    rng = np.random.default_rng(1)
    fm.w[:], fm.w0 = rng.normal(0, 1, 64), 0.3
    fm.v[:] = rng.normal(0, 1, fm.v.shape)
    rows = [np.array([3, 9, 40]), np.array([], int), np.array([5]), np.arange(20)]
    idx, row = np.concatenate(rows).astype(int), np.repeat(np.arange(4), [len(r) for r in rows])
    got = fm.raw(idx, row, 4)[0]
    for r, z in zip(rows, got):
        plain = fm.w0 + sum(fm.w[i] for i in r) + sum(float(fm.v[i] @ fm.v[j]) for a, i in enumerate(r) for j in r[:a])
        assert z == pytest.approx(plain, abs=1e-3)
    p = fm.proba(idx, row, 4)
    assert p == pytest.approx(1 / (1 + np.exp(-np.clip(got, -30, 30))))
