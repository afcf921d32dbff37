"""Sharding (operator 9): two-pass external shuffle.

Pass 1 scatters the records uniformly into memory-sized buckets by a seeded
hash of id and text.  Pass 2 takes one bucket at a time into a task, shuffles
it (Fisher-Yates, seeded by the bucket) and writes it in its new order.  The
bucket sizes, one number per bucket, give every record its place in the whole
permutation; shard = place * shards / rows, so counts differ by at most one
row (law ``rows``).

Copies of a text with different ids spread like all other rows.  Rows that repeat id and text in more than an
eighth of a bucket's bytes are dealt to as many parts as it takes, each hashed by itself.  The number of
buckets follows the input's bytes, and a task never holds more than one
bucket.  A bucket is sorted by hashes of id and text and of the whole row before its permutation, so a task run again after a
lost executor gives the same order.

Defined results: null text has no bytes (size 16, crc32 0), a null doc_id is a
value like any other, wholly repeated rows keep one place each, an empty table gives no rows, further columns travel along inside
``row``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import ship_package
from strata.session import materialize

ROW_OVERHEAD = 16
BUCKET_BYTES = 24 << 20


def _fisher_yates(seed: int, base: np.ndarray, rows: int, shards: int):
    def shuffle(t: pa.Table) -> pa.Table:
        bucket = t.column("bucket")[0].as_py()
        n = t.num_rows
        t = t.take(pc.sort_indices(t, sort_keys=[("key", "ascending"), ("whole", "ascending")]))
        # Generator.permutation is a Fisher-Yates shuffle of 0 .. n-1
        order = np.random.default_rng([seed, bucket]).permutation(n)
        place = [int(base[bucket]) + i for i in range(n)]
        shard = [p * shards // rows for p in place]
        # first place of shard s: ceil(s * rows / shards)
        slot = [p - -(-s * rows // shards) for p, s in zip(place, shard)]
        return pa.table({"row": t.column("row").take(pa.array(order)),
                         "shard": pa.array(shard, pa.int32()), "slot": pa.array(slot, pa.int64())})
    return shuffle


def shuffle_into_shards(docs: DataFrame, shards: int, path: str, seed: int = 17,
                        bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write ``docs`` as ``shards`` shuffled shards under ``path`` (Parquet, one
    folder ``shard=s`` each) and return them as read back: ``row`` (all columns
    of the record), ``shard``, ``slot`` (gapless from 0 in its shard)."""
    spark = docs.sparkSession
    ship_package(spark)
    total = docs.agg(F.sum(F.octet_length("text") + F.lit(ROW_OVERHEAD))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("doc_id").isNull(), F.col("text"))
    columns = [F.to_json(F.col(c)) if "map<" in t else F.col(c) for c, t in docs.dtypes]
    keyed = docs.select(F.struct(*docs.columns).alias("row"), key.alias("key"), F.xxhash64(*columns).alias("whole"))
    # rows of one key beyond a share of a bucket: at most 8 keys for each bucket
    share = max(1, bucket_bytes // 8)
    size = docs.select(key.alias("key"), (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(ROW_OVERHEAD)).alias("b"))
    hot = size.groupBy("key").agg(F.sum("b").alias("b")).filter(F.col("b") > share).select(
        F.col("key").alias("_key"), F.ceil(F.col("b") / share).alias("_parts")).collect()
    part = F.lit(0).cast("long")
    if hot:
        found = F.broadcast(spark.createDataFrame(hot, "_key long, _parts long"))
        keyed = keyed.join(found, F.col("key") == F.col("_key"), "left")
        part = F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("_parts")), F.lit(0))
    keyed = keyed.select("row", "key", "whole", F.pmod(F.xxhash64(F.lit(seed), "key", part), F.lit(buckets)).alias("bucket"))
    if hot:  # parts go by the rows' numbers: written once, as the sizes and the rows below must agree on them
        keyed = materialize(keyed, "sharding-parts")
    sizes = np.zeros(buckets + 1, np.int64)
    for r in keyed.groupBy("bucket").count().collect():  # one number per bucket
        sizes[r[0] + 1] = r[1]
    base = np.cumsum(sizes)
    schema = keyed.select("row", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).schema
    placed = keyed.groupBy("bucket").applyInArrow(
        _fisher_yates(seed, base, max(int(base[-1]), 1), shards), schema)
    placed.write.partitionBy("shard").parquet(path)
    return spark.read.schema(schema).parquet(path)
