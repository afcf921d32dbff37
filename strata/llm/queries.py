"""Registered queries of the operators: thin wrappers that read whole tables,
apply the operator with its production parameters and derive digest columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.llm.codes import codebooks_sha256, label_errors, vector_codes
from strata.llm.decontaminate import contamination
from strata.llm.exact import exact_groups
from strata.llm.lexical import search
from strata.llm.lines import line_run_dedup
from strata.llm.minhash import near_classes
from strata.llm.ngram_join import jaccard_components
from strata.llm.packing import pack_sequences
from strata.llm.sharding import ROW_OVERHEAD, shuffle_into_shards
from strata.llm.substring import substring_dedup
from strata.llm.suffixes import suffix_dedup
from strata.llm.tables import documents, id_text, table
from strata.llm.token_store import read_tokens, write_tokens
from strata.llm.toxicity import THRESHOLD, score_toxicity
from strata.session import scratch_path


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash_neardup(spark, sf_dir):
    return near_classes(documents(spark, sf_dir)).select("doc_id", "class_id", "class_size", "n_links")


def op2_substring_dedup(spark, sf_dir):
    kept = substring_dedup(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_exact_dedup(spark, sf_dir):
    return exact_groups(documents(spark, sf_dir))


def op4_token_output(spark, sf_dir):
    path = scratch_path(spark, "tokens")
    write_tokens(documents(spark, sf_dir), path, _tokenizer("byte_bpe_50k.json"), end_id=0)
    return read_tokens(spark, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op5_packing(spark, sf_dir):
    pieces = pack_sequences(documents(spark, sf_dir), _tokenizer("word_bpe_49k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_line_dedup(spark, sf_dir):
    kept = line_run_dedup(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_suffix_array_dedup(spark, sf_dir):
    kept = suffix_dedup(documents(spark, sf_dir))
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op8_toxicity(spark, sf_dir):
    scored = score_toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op9_sharding(spark, sf_dir):
    rows = id_text(documents(spark, sf_dir))
    placed = shuffle_into_shards(rows, 40, scratch_path(spark, "shards"))
    text = F.coalesce(F.col("row.text"), F.lit("")).cast("binary")
    return placed.select(
        F.col("row.doc_id").alias("doc_id"), (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op10_benchmark_decontamination(spark, sf_dir):
    found = contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op11_vector_codes(spark, sf_dir):
    codes, books = vector_codes(table(spark, sf_dir, "embeddings"))
    digits = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return label_errors(codes).select("vec_id", digits.alias("code"), "error", "label_error",
                                      F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))


def op12_ngram_jaccard(spark, sf_dir):
    return jaccard_components(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op13_lexical_search(spark, sf_dir):
    return search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


REGISTRY = {f.__name__: f for f in (
    op1_minhash_neardup, op2_substring_dedup, op3_exact_dedup, op4_token_output, op5_packing, op6_line_dedup, op7_suffix_array_dedup, op8_toxicity, op9_sharding,
    op10_benchmark_decontamination, op11_vector_codes, op12_ngram_jaccard, op13_lexical_search)}
