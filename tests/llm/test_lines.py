"""Repeated runs of lines against a version that knows nothing of chunks or hashes."""

from __future__ import annotations

import random

from test_operators import docs, empty, prose, small  # noqa: F401

from strata.llm import lines
from strata.llm.lines import line_run_dedup


def plain(texts):
    """Removed lines of every text: those in a pair of lines that stands earlier."""
    seen, out = set(), []
    for t in texts:
        rows, gone = (t or "").split("\n"), set()
        for i, pair in enumerate(zip(rows, rows[1:])):
            if "".join(pair).strip(" \t\r\x0b\f") and pair in seen:
                gone |= {i, i + 1}
            seen.add(pair)
        out.append((len(rows), sorted(gone), "\n".join(r for i, r in enumerate(rows) if i not in gone)))
    return out


def compare(spark, texts):
    out = line_run_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(texts)
    for i, (n, gone, kept) in enumerate(plain(texts)):
        spans = [(s["start"], s["end"]) for s in got[i]["spans"]]
        assert (got[i]["n_lines"], got[i]["n_removed"], got[i]["kept_text"]) == (n, len(gone), kept)
        assert [x for a, b in spans for x in range(a, b)] == gone
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))
    return got


def passages(rng, of=(2, 3, 4, 6, 8, 12, 24), each=6):
    """Passages of n lines, each in two hosts; (n, number of the second host, text)."""
    texts, second = [], []
    for n in of:
        for _ in range(each):
            p = [prose(rng, rng.randint(1, 9)) + str(rng.random()) for _ in range(n)]
            for _ in range(2):
                head, tail = ([prose(rng, 6) + str(rng.random()) for _ in range(rng.randint(0, 7))] for _ in range(2))
                texts.append("\n".join(head + p + tail))
            second.append((n, len(texts) - 1))
    return texts, second


def test_runs_of_every_length_go_whole(spark, small):  # noqa: F811
    texts, second = passages(random.Random(21))
    got = compare(spark, texts)
    assert all(got[i]["n_removed"] == n for n, i in second)


def test_runs_at_edges(spark, small):  # noqa: F811
    rng = random.Random(22)
    few = ["a", "b", "", " ", "c\r", "é"]
    texts = ["\n".join(rng.choice(few) for _ in range(rng.randint(0, 9))) for _ in range(60)]
    texts += [None, "", "\n", "\n\n\n", "a\n", "\na", "one line", "one line", "x\nx\nx\nx", "q\n" * 50, " \n\t ", " \n\t "]
    texts += ["long " * 900 + "\n" + "line " * 900] * 5
    compare(spark, texts)


def test_equal_hashes_of_other_bytes(spark, small, monkeypatch):  # noqa: F811
    from strata.llm.blocks import Block

    class Narrow(lines.Windows):
        def __init__(self, block):
            super().__init__(block)
            self.hash = self.hash % 3

    texts, _ = passages(random.Random(23), each=2)

    class One(Block):
        def __init__(self):
            self.texts = [t.encode() for t in texts]

    w = Narrow(One())
    first = {}
    assert w.firsts().tolist() == [first.setdefault(w.body(i), i) for i in range(len(w.at))]


def test_repeated_rows_and_ids(spark, docs, empty, small):  # noqa: F811
    out = line_run_dedup(docs)
    assert out.count() == docs.count() and line_run_dedup(empty).count() == 0
    n = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in out.collect()}
    assert n[13] == (12, 0) and n[14] == (14, 12) and n[15] == (12, 12)
    rows = [(5, "a\nb\nc"), (5, "a\nb\nc"), (5, "b\nc\nd"), (None, "c\nd"), (None, "c\nd")]
    out = line_run_dedup(docs.sparkSession.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(r["n_removed"] for r in out if r["doc_id"] is None) == 4
    kept = "\n".join(r["kept_text"] for r in out).split("\n")
    assert set("abcd") <= set(kept)
