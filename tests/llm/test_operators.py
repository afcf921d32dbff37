"""Each operator against its plain version, on a fixture of nulls in every
column, empty and long texts, ties, repeated rows and clashing extra columns."""

from __future__ import annotations

import random

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from strata.llm import blocks
from strata.llm.decontaminate import contamination, decontaminate
from strata.llm.exact import exact_dedup, exact_groups
from strata.llm.lines import line_dedup
from strata.llm.minhash import consistent_samples, near_classes, near_dedup, weighted_jaccard, VECTOR
from strata.llm.packing import hilbert_key, pack_sequences
from strata.llm.ranges import range_of
from strata.llm.sharding import shuffle_into_shards
from strata.llm.substring import substring_dedup
from strata.llm.suffixes import COVER, PERIOD, suffix_dedup
from strata.llm.token_store import PerfectHash, fetch, mix, read_tokens, write_tokens
from strata.llm.tokens import Encoder
from strata.llm.toxicity import drop_toxic, score_toxicity

BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(n))


def corpus():
    rng = random.Random(3)
    base, passage = prose(rng, 160), prose(rng, 90)
    lines = "\n".join(prose(rng, 6) for _ in range(12))
    near = base.split()
    near[70] = "changed"
    texts = [base, base, " ".join(near), passage, "x y " + passage + " z", prose(rng, 30) + passage, "", None, None, " \n\t ",
             "one", "one", "two words", lines, "head\n" + lines + "\ntail", lines, prose(rng, 5000), "ab" * 900, "ab" * 900 + "c",
             passage.upper(), "a  b\x0bc\x0cd\r\ne", "İ ʼn \x1c 　 x"]
    rows = [(i, t) for i, t in enumerate(texts)]
    # ties: a doc_id twice, with equal and with other text; null ids
    return rows + [(0, base), (3, "other text of the same id"), (None, passage), (None, None), (None, base)]


ROWS = corpus()
ITEMS = [(1, " ".join(ROWS[3][1].split()[20:45])), (1, " ".join(ROWS[3][1].split()[20:45])), (2, "two words"), (3, None), (4, ""),
         (None, " ".join(ROWS[16][1].split()[100:112])), (10, "nowhere at all to be found in any of these many texts")]


@pytest.fixture(scope="module")
def docs(spark):
    """doc_id and text between columns whose names operators use themselves."""
    schema = ("block int, doc_id long, text string, bucket string, rank int, node string, label int, _h string, key long, "
              "score double, shard int, slot long, fp long")
    rows = [(i if i % 3 else None, d, t, "b" if i % 2 else None, None, "n", 1, "h", 5, 0.5, 7, None, 9) for i, (d, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def empty(spark, docs):
    return spark.createDataFrame([], docs.schema)


@pytest.fixture
def small(monkeypatch):
    """Many blocks, so that hashes are exchanged between them."""
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 6000)
    monkeypatch.setattr(blocks, "BUCKET_HASHES", 900)


def got(df, *cols):
    return sorted(map(repr, df.select(*cols).collect()))


def want(df, *cols, rows):
    """The plain rows in the shape of ``got``; ids that stand for null are null again."""
    spark, types = df.sparkSession, df.select(*cols).schema
    rows = [tuple(None if isinstance(x, float) and x == float("inf") else x for x in r) for r in rows]
    return sorted(map(repr, spark.createDataFrame(rows, types).collect()))


def test_op2_substring(docs, empty, small):
    out = substring_dedup(docs).withColumn("sha", F.sha2("kept_text", 256))
    cols = ("doc_id", "n_words", "n_removed", "sha")
    assert got(out, *cols) == want(out, *cols, rows=brute.op2(ROWS))
    assert out.filter("n_removed > 0").count() > 3
    for r in out.collect():
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
    assert substring_dedup(empty).count() == 0


def test_op3_exact(docs, empty):
    cols = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    out = exact_groups(docs)
    assert got(out, *cols) == want(out, *cols, rows=brute.op3(ROWS))
    kept = exact_dedup(docs)
    assert kept.columns == docs.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in ROWS})
    assert exact_groups(docs, keep="smallest").filter("keep_id = 10").count() == 2
    assert exact_groups(empty).count() == 0 and exact_dedup(empty).count() == 0


def test_op4_tokens(spark, docs, empty, tmp_path):
    path = str(tmp_path / "store")
    write_tokens(docs, path, BYTE_BPE, 0, shard_bytes=4000)
    assert spark.read.parquet(path).count() > 2
    out = [(r["doc_id"], r["start"], bytes(r["ids"])) for r in read_tokens(spark, path).collect()]
    ids = brute.encode(BYTE_BPE, [t for _, t in ROWS], 0)
    assert sorted((d is None, d or 0, x) for d, _, x in out) == sorted(
        (d is None, d or 0, x.tobytes()) for (d, _), x in zip(ROWS, ids))
    out.sort(key=lambda r: r[1])
    at, last = 0, -1
    for d, start, x in out:  # gapless, ascending ids, nulls last
        assert start == at and (d if d is not None else 1 << 60) >= last
        at, last = at + len(x) // 4, d if d is not None else 1 << 60
    found = {r["doc_id"]: bytes(r["ids"]) for r in fetch(spark, path, spark.createDataFrame(
        [(5,), (16,), (999,), (None,)], "doc_id long")).collect()}
    assert found == {5: ids[5].tobytes(), 16: ids[16].tobytes()}
    write_tokens(empty, str(tmp_path / "none"), BYTE_BPE, 0)
    assert read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_perfect_hash_is_minimal():
    h = mix(np.arange(5000, dtype=np.uint64), 9)
    p = PerfectHash.load(PerfectHash.build(h).dump())
    assert sorted(p.slot(h).tolist()) == list(range(5000))


def test_encoder_equals_the_library():
    texts = [t for _, t in ROWS] + ["a  b \n c", " x", "x ", "it's 12 3's", "<|endoftext|> a", "é é ̈x  ", "x  \x85 y"]
    for path in (BYTE_BPE, WORD_BPE):
        e = Encoder(path, known=50)
        plain = e.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
        assert e.encode(texts) == [np.array(x.ids, "<u4").tobytes() for x in plain]


def test_op5_packing(docs, empty):
    out = pack_sequences(docs, WORD_BPE, 1, length=256, range_ids=700).collect()
    whole = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert len(r["ids"]) == 4 * r["length"] <= 4 * 256
        seq = whole.setdefault(r["sequence_id"], [])
        assert r["offset"] == len(seq)
        seq += [r["doc_id"]] * r["length"]
    assert all(len(s) == 256 for k, s in whole.items() if k != max(whole)) and sorted(whole) == list(range(len(whole)))
    # pieces of documents with an id of their own join to the document
    ids = brute.encode(WORD_BPE, [t for _, t in ROWS], 1)
    once = [i for i, (d, _) in enumerate(ROWS) if d is not None and sum(x == d for x, _ in ROWS) == 1]
    for i in once:
        mine = sorted((r for r in out if r["doc_id"] == ROWS[i][0]), key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in mine) == ids[i].tobytes() and mine[0]["doc_tokens"] == len(ids[i])
    assert sum(r["length"] for r in out) == sum(map(len, ids))
    assert pack_sequences(empty, WORD_BPE, 1).count() == 0


def test_hilbert_neighbours_touch():
    cells = np.stack(np.meshgrid(*[np.arange(4)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = hilbert_key(cells, bits=2)
    assert sorted(key.tolist()) == list(range(64))
    walk = cells[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_op6_lines(docs, empty, small):
    out = line_dedup(docs).withColumn("sha", F.sha2("kept_text", 256))
    rows = sorted({r for r in ROWS if r[0] is not None and r[0] not in (0, 3)}, key=lambda r: r[0])
    cols = ("doc_id", "n_lines", "n_removed", "sha")
    mine = out.filter("doc_id is not null and doc_id not in (0, 3)")
    assert got(mine, *cols) == want(out, *cols, rows=brute.op6(rows))
    assert out.filter("n_removed > 0").count() >= 2 and out.count() == len(ROWS)
    assert line_dedup(empty).count() == 0


def test_op7_suffixes(docs, empty, small):
    out = suffix_dedup(docs).withColumn("n", F.size("spans").cast("long")).withColumn("sha", F.sha2("kept", 256))
    cols = ("doc_id", "n_bytes", "n_removed", "n", "sha")
    assert got(out, *cols) == want(out, *cols, rows=brute.op7(ROWS))
    assert out.filter("n_removed > 0 and n_removed < n_bytes").count() > 2
    assert suffix_dedup(empty).count() == 0


def test_op7_shifts_and_edges(spark, small):
    """Repeats of 399 to 800 bytes, at every shift of the cover's period."""
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcd ") for _ in range(n))
    rows = []
    for i in range(24):
        p = text(rng.choice([399, 400, 401, 420, 532, 533, 800]))
        rows += [(2 * i, text(rng.randint(0, 300)) + p + text(rng.randint(0, 300))), (2 * i + 1, text(rng.randint(0, 300)) + p)]
        if i % 5 == 0:  # a third holder that differs within the passage
            rows.append((1000 + i, text(17) + p[:410] + text(300)))
    out = suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    out = out.withColumn("n", F.size("spans").cast("long")).withColumn("sha", F.sha2("kept", 256))
    cols = ("doc_id", "n_bytes", "n_removed", "n", "sha")
    assert got(out, *cols) == want(out, *cols, rows=brute.op7(rows))


def test_difference_cover():
    assert {int(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_op9_shards(spark, docs, empty, tmp_path):
    out = shuffle_into_shards(docs, 5, str(tmp_path / "shards"), bucket_bytes=5000)
    by = {}
    for r in out.collect():
        by.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(v) for v in by.values()]
    assert len(by) == 5 and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert got(out.select("row.*"), *docs.columns) == got(docs, *docs.columns)
    again = shuffle_into_shards(docs, 5, str(tmp_path / "again"), bucket_bytes=5000)
    assert got(out, "row.doc_id", "shard", "slot") == got(again, "row.doc_id", "shard", "slot")
    assert shuffle_into_shards(empty, 5, str(tmp_path / "none")).count() == 0


def test_op10_benchmark(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("sha"), (F.col("n_hit") > 0).alias("hit"))
    assert got(out, *out.columns) == want(out, *out.columns, rows=brute.op10(ROWS, ITEMS))
    kept = decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.count() == out.filter("not hit").count()
    assert contamination(empty, items).count() == 0
    assert contamination(docs, items.limit(0)).filter("n_hit > 0").count() == 0


def test_op10_repetition(spark):
    """Runs of one word, where every gram and every minimum is the same."""
    rows = [(1, "a " * 40), (2, "b " * 9), (3, "x " + "a " * 10), (4, "a b " * 12), (5, "a " * 9)]
    items = [(1, "a " * 10), (2, "b a " * 6), (3, "b b b")]
    d, b = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    out = contamination(d, b).select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n"),
                                     F.sha2(F.array_join("item_ids", ","), 256).alias("sha"), (F.col("n_hit") > 0).alias("hit"))
    assert got(out, *out.columns) == want(out, *out.columns, rows=brute.op10(rows, items))


def test_op1_near(docs, empty, small):
    out = near_classes(docs)
    cls = {}
    for r in out.collect():
        cls.setdefault(r["text_md5"], r["class_id"])
    assert out.count() == len(ROWS)
    by_id = {r["doc_id"]: r["class_id"] for r in out.collect() if r["doc_id"] not in (3, None)}
    assert by_id[0] == by_id[1] == by_id[2] == 0  # copies and the one-word change
    assert by_id[4] == 3  # the passage with three more words
    assert by_id[10] == by_id[11] == 10 and by_id[12] == 12 and by_id[16] == 16
    kept = near_dedup(docs)
    assert kept.columns == docs.columns
    # two classes have the id 3, which is that of two documents
    assert kept.count() == out.select("class_id").distinct().count() + 1
    assert near_classes(empty).count() == 0 and near_dedup(empty).count() == 0


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    h = rng.integers(1, 1 << 40, 300).astype(np.uint64)
    a, b = np.empty(200, VECTOR), np.empty(200, VECTOR)
    a["h"], b["h"] = np.sort(h[:200]), np.sort(h[60:260])
    a["w"], b["w"] = rng.integers(1, 4, 200), rng.integers(1, 4, 200)
    s = consistent_samples(np.concatenate([a["h"], b["h"]]), np.concatenate([a["w"], b["w"]]).astype(float), np.array([0, 200]), 1500)
    assert abs((s[0] == s[1]).mean() - weighted_jaccard(a, b)) < 0.05


def test_op8_toxicity(spark, empty):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        bad = i % 6 == 0
        # an insult alone or a group alone is fine; both together are not
        words = prose(rng, 30).split() + (["insult", "group"] if bad else ["insult"] if i % 2 else ["group"])
        rng.shuffle(words)
        rows.append((i, " ".join(words), "x", 1))
        labels.append((i, 0, int(bad)))
    rows += [(600, None, None, None), (601, "", "y", 2), (None, "insult group", None, 3)]
    labels += [(601, None, None), (None, 1, 1), (5, 1, 0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, score string, label int")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    s = {r["doc_id"]: r for r in score_toxicity(d, lab, bits=14).collect()}
    assert len(s) == 604 - 1 and all(0 <= r["score"] <= 1 for r in s.values())
    held = [i for i in range(600) if s[i]["held_out"]]
    right = sum((s[i]["score"] >= 0.3) == (i % 6 == 0) for i in held)
    assert len(held) > 100 and right >= 0.97 * len(held)
    kept = drop_toxic(d, lab, bits=14)
    assert kept.columns == d.columns and 480 <= kept.filter("doc_id < 600").count() <= 520
    assert score_toxicity(d.limit(0), lab).count() == 0
    assert {r["score"] for r in score_toxicity(d, lab.limit(0)).collect()} == {score_toxicity(d, lab.limit(0)).first()["score"]}


def test_ranges_spread_hot_and_null_keys():
    cuts = np.array([5, 9, 9, 9, 9, 20])
    key = np.array([1, 5, 7] + [9] * 400 + [15, 30])
    out, rank = range_of(key, np.zeros(len(key), bool), mix(np.arange(len(key), dtype=np.uint64), 1), cuts)
    assert out[:3].tolist() == [0, 0, 1] and out[-2:].tolist() == [5, 6]
    hot = out[3:-2]
    assert set(hot) == {2, 3, 4} and set(rank[3:-2]) == {2}
    null, _ = range_of(key, np.ones(len(key), bool), mix(np.arange(len(key), dtype=np.uint64), 1), cuts, null_ranges=4)
    assert set(null) == {7, 8, 9, 10}
