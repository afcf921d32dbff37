"""The corpus pipeline: documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again as the next stage's docs.  All but the last return the columns
of documents.  Every decision takes effect: what a stage drops is gone.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.decontaminate import decontaminate
from strata.llm.exact import exact_dedup
from strata.llm.minhash import near_dedup
from strata.llm.packing import pack_sequences
from strata.llm.tables import documents, release_driver, table
from strata.llm.toxicity import drop_toxic
from strata.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one of the largest doc_id."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one of the smallest doc_id."""
    return near_dedup(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with digests of their ids."""
    pieces = pack_sequences(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact),
    ("minhash_near_dedup", near),
    ("benchmark_decontamination", benchmark),
    ("packing", packing),
]

#: A trained model, hashed sampling and tokenization: SQL can't express run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        release_driver(spark)  # what the stage held is gone before the next one
    return docs
