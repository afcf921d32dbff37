"""A third of all rows alike in every column, 64-bit ids beyond 2^53, and colliding hashes."""

import random

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F
from test_operators import ROWS, got, prose, want

from strata.llm import blocks, frequencies, substring
from strata.llm.frequencies import code_of, codes_for, counted_rows, frequency_of, squeeze, unsqueeze
from strata.llm.minhash import FLOOR, idf, near_classes
from strata.llm.packing import pack_sequences
from strata.llm.ranges import cut_points, range_of
from strata.llm.sharding import shuffle_into_shards
from strata.llm.substring import substring_dedup
from strata.llm.token_store import mix

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BIG = 2 ** 60 + 12345


def repeated(spark, n=300):
    rng = random.Random(6)
    one = prose(rng, 12)
    rows = [(7, one, "x")] * (n // 3) + [(None, one, "y")] * 20 + [(1000 + i, prose(rng, rng.randint(1, 25)), None) for i in range(2 * n // 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, extra string").repartition(4)


def test_sharding_deals_repeated_rows_to_several_buckets(spark, tmp_path):
    docs = repeated(spark)
    out = shuffle_into_shards(docs, 4, str(tmp_path / "s"), bucket_bytes=3000).collect()
    by = {}
    for r in out:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(map(len, by.values())) == [80] * 4 and all(sorted(v) == list(range(80)) for v in by.values())
    assert sorted(map(repr, (tuple(r["row"]) for r in out))) == sorted(map(repr, map(tuple, docs.collect())))
    # the equal rows lie all over the shards' places, as shuffled rows do, in no run of a bucket's length
    places = sorted(80 * r["shard"] + r["slot"] for r in out if r["row"]["doc_id"] == 7)
    gaps = np.diff(places)
    assert places[0] < 40 and places[-1] > 280 and gaps.max() < 60


def test_packing_deals_repeated_rows_to_several_ranges(spark):
    docs = repeated(spark)
    out = pack_sequences(docs, WORD_BPE, 1, length=64, range_ids=300).collect()
    ids = brute.encode(WORD_BPE, [r["text"] for r in docs.collect()], 1)
    assert sum(r["length"] for r in out) == sum(map(len, ids))
    filled = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert sorted(filled) == list(range(len(filled))) and all(n == 64 for s, n in filled.items() if s != max(filled))
    assert sum(r["start"] == 0 and r["doc_id"] == 7 for r in out) == 100


def test_cuts_tell_large_ids_apart(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(BIG)).otherwise(F.lit(2 ** 60) + F.pmod(F.xxhash64("id"), F.lit(100_000))).alias("k"))
    cuts = cut_points(df, "k", 12)
    key = np.array([r["k"] for r in df.collect()])
    part, rank = range_of(key, np.zeros(len(key), bool), mix(np.arange(len(key), dtype=np.uint64), 1), cuts)
    sizes = np.bincount(part)
    assert len(cuts) == 11 and BIG in cuts.tolist() and sizes.max() < 400 and len(set(rank[key == BIG])) == 1
    assert len(cut_points(df.limit(0), "k", 5)) == 0 and len(cut_points(df, "k", 1)) == 0


def test_large_ids_through_a_block_operator(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 3000)
    rng = random.Random(9)
    passage = prose(rng, 40)
    rows = [(BIG if i % 3 == 0 else 2 ** 60 + i, prose(rng, 9) + " " + (passage if i % 4 == 0 else prose(rng, 30))) for i in range(60)]
    out = substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("sha", F.sha2("kept_text", 256))
    cols = ("doc_id", "n_words", "n_removed", "sha")
    assert got(out, *cols) == want(out, *cols, rows=brute.op2(rows))


def by(tables, column):
    """A shuffle in this process: one table for each value of the column."""
    t = pa.concat_tables(tables)
    return {v: t.filter(pc.equal(t.column(column), v)) for v in sorted(set(t.column(column).to_pylist()))}


@pytest.mark.parametrize("narrow", ["first", "second"])
def test_substring_with_colliding_hashes(monkeypatch, narrow):
    """The operator's own steps with one of its two hashes cut to two bits: windows stay apart by the other."""
    windows, second = blocks.Words.windows, blocks.Words.second
    if narrow == "first":
        monkeypatch.setattr(blocks.Words, "windows", lambda self, k: (windows(self, k)[0], windows(self, k)[1] & np.uint64(3)))
    else:
        monkeypatch.setattr(blocks.Words, "second", lambda self, k, at: second(self, k, at) & np.uint64(3))
    rows = [(d, t) for d, t in ROWS if d is not None]
    batch = pa.record_batch({"doc_id": pa.array([d for d, _ in rows], pa.int64()), "text": pa.array([(t or "").encode() for _, t in rows]),
                             "salt": pa.array(range(len(rows)), pa.int64())})
    packed = by([pa.Table.from_batches([x]) for x in blocks._pack(np.array([3, 8, 15]), 1)([batch])], "block")
    codes = [frequencies.frequencies(t) for t in by([substring._emit(13, 3)(t) for t in packed.values()], "bucket").values()]
    told = by(codes, "block")
    none = pa.concat_tables(codes).slice(0, 0)
    pairs = [substring._emit_pairs(13, 3)(t, told.get(k, none)) for k, t in packed.items()]
    late = [substring._judge(t) for t in by(pairs, "bucket").values()]
    late = pa.concat_tables(late).rename_columns(["block", "codes"])
    out = []
    for k, t in packed.items():
        mine = told.get(k, none)
        mine = mine.append_column("kind", pa.array([1] * mine.num_rows, pa.int32()))
        other = late.filter(pc.equal(late.column("block"), k))
        other = pa.table({"block": other.column("block"), "bucket": pa.array([0] * other.num_rows, pa.int32()), "codes": other.column("codes"),
                          "kind": pa.array([2] * other.num_rows, pa.int32())})
        r = substring._remove(13, 3)(t, pa.concat_tables([mine, other]))
        out += [(d, n, g, brute.sha(x.encode())) for d, n, g, x in zip(*(r.column(c).to_pylist() for c in ("doc_id", "n_words", "n_removed", "kept_text")))]
    assert sorted(out) == sorted(brute.op2(rows)) and sum(g > 0 for _, _, g, _ in out) > 2


class One:
    block, rank = 3, 0


def test_frequencies_are_exact_where_32_bits_differ():
    rng = np.random.default_rng(2)
    pool = np.unique(rng.integers(0, 1 << 63, 3000).astype(np.uint64))
    sent, want_df = [], dict.fromkeys(pool.tolist(), 0)
    for k in range(5):
        h = np.sort(rng.choice(pool, 900, replace=False))
        n = rng.integers(1, 4, len(h))
        for x, c in zip(h.tolist(), n.tolist()):
            want_df[x] += c
        sent.append((k, h, n))
    def rows(k, h, n):
        one = One()
        one.block = k
        return counted_rows(one, h, n, 4)

    table = pa.concat_tables([rows(*x) for x in sent])
    told = []
    for b in range(4):
        part = table.filter(pc.equal(table.column("bucket"), b))
        told.append(frequencies.frequencies(part))
    told = pa.concat_tables(told)
    for k, h, _ in sent:
        mine = told.filter(pc.equal(told.column("block"), k))
        codes = codes_for(h, 4, mine)
        assert (codes == code_of(np.array([want_df[x] for x in h.tolist()]))).all()
    x = rng.integers(0, 1 << 32, 1000).astype(np.uint32)
    assert (unsqueeze(squeeze(x), 1000) == x).all()
    assert code_of(np.array([1, 2, 3, 10 ** 9])).tolist() == [0, 12, 19, 255] and frequency_of(np.array([12.0])).tolist() == [2.0]


def test_equal_low_bits_only_look_more_frequent():
    a = np.array([(1 << 40) | 5, (2 << 40) | 5], np.uint64)  # 32 bits agree
    told = [frequencies.frequencies(counted_rows(One(), a, np.ones(2, np.int64), 1))]
    assert codes_for(a, 1, pa.concat_tables(told)).tolist() == [12, 12]


# -------------------------------------------------- near duplicates at every share
def family(n, share, seed=3):
    rng = random.Random(seed)
    base = prose(rng, 120).split()
    rows = []
    for i in range(n):
        if i < share * n:
            w = list(base)
            w[rng.randrange(len(w))] = f"w{i}"  # 5 of 116 shingles: plain similarity of two members from 0.84
            rows.append((i, " ".join(w)))
        else:
            rows.append((i, prose(rng, 60)))
    return rows


@pytest.mark.parametrize("n,share", [(2, 1), (5, 0.6), (60, 0.5), (60, 1), (80, 0.1)])
def test_family_of_any_share_is_one_class(spark, n, share):
    rows = family(n, share)
    out = {r["doc_id"]: r["class_id"] for r in near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    members = [i for i in range(n) if i < share * n]
    assert {out[i] for i in members} == {0} and all(out[i] == i for i in range(n) if i not in members)


def test_idf_from_one_to_the_floor():
    assert idf(np.array([1, 10, 100]), 100).tolist() == [1.0, pytest.approx(FLOOR + (1 - FLOOR) / 2), FLOOR]
    assert idf(np.array([1]), 1).tolist() == [1.0]


def test_near_classes_equal_all_pairs(spark, monkeypatch):
    """Classes of the operator against all pairs of weighted similarity 0.8, on families around it."""
    from strata.llm.blocks import Words
    from strata.llm.minhash import shingles

    monkeypatch.setattr(blocks, "BLOCK_BYTES", 20_000)
    rng = random.Random(11)
    rows = []
    for _ in range(12):
        base = prose(rng, rng.choice([30, 90, 200])).split()
        for _ in range(8):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                w[rng.randrange(len(w))] = f"w{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(w)))
    doc, h, n = shingles([t.encode() for _, t in rows])
    assert Words
    distinct, place, df = np.unique(h, return_inverse=True, return_counts=True)
    weight = n * idf(frequency_of(code_of(df)), len(rows))[place]
    vectors = [dict(zip(h[doc == d].tolist(), weight[doc == d].tolist())) for d in range(len(rows))]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    border = 0
    for i, a in enumerate(vectors):
        for j in range(i):
            b = vectors[j]
            low = sum(min(w, b[x]) for x, w in a.items() if x in b)
            s = low / (sum(a.values()) + sum(b.values()) - low)
            border += abs(s - 0.8) < 1e-6
            if s >= 0.8:
                root[find(i)] = find(j)
    assert not border
    least = {}
    for i in range(len(rows)):
        least.setdefault(find(i), i)
    out = {r["doc_id"]: r["class_id"] for r in near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {i: least[find(i)] for i in range(len(rows))}
