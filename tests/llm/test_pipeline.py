"""The pipeline on a small table, stage by stage against plain versions."""

import random

import brute
import corpus_pipeline
import public_tokenizers
from test_operators import prose

import __spark_entry__ as entry


def make(spark, path):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(240):
        words = prose(rng, 60).split()
        if i % 8 == 0:
            words += ["vile", "slur"]
        rng.shuffle(words)
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(i % 8 == 0)))
    clean = [r for r in rows if r[0] % 8]
    passage = prose(rng, 20)
    near = clean[3][1].split()
    near[20] = "altered"
    rows += [(300, clean[0][1], "en", "s", 1), (301, " ".join(near), "en", "s", 1),
             (302, prose(rng, 10) + " " + passage + " " + prose(rng, 10), "en", "s", 1), (303, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return rows, clean


def test_pipeline(spark, tmp_path):
    rows, clean = make(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out/{name}")
        docs = spark.read.parquet(f"{tmp_path}/out/{name}")
        left.append({r["doc_id"] for r in docs.select("doc_id").collect()})
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    toxic, exact, near, bench, packed = left
    assert toxic == {r[0] for r in rows if r[0] >= 240 or r[0] % 8}
    assert exact == toxic - {clean[0][0]}  # the largest id of a text stays
    assert near == exact - {301}  # the smallest id of a class stays
    assert bench == near - {302} and packed == bench
    text = {r[0]: r[1] for r in rows}
    ids = {d: x for d, x in zip(bench, brute.encode(public_tokenizers.path("word_bpe_49k.json"), [text[d] for d in bench], 1))}
    for r in docs.collect():
        assert brute.crc(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]) == r["ids_crc32"]
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert run.count() == docs.count()


def test_entry_registers_all():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
