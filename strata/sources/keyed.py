"""Keyed tables on Spark's own writers: Parquet folders partitioned by a place that follows from the key.

A row's place is a function of its key (by default ``pmod(hash(keys), buckets)``), written as the partition
column ``_place``.  An upsert stages its updates once, reads only their places (a partition filter, so the scan lists and
reads nothing else), combines both sides and publishes the result with
``partitionOverwriteMode=dynamic``: Spark replaces exactly the partitions written and leaves the rest alone.  There is no log and no
version: a reader sees plain partitioned Parquet.

Guarantees: Spark moves finished partitions into place when the job commits, so a lost
executor or a failed job leaves the table as it was.  The moves of one commit are not one step: a driver that
dies among them leaves some places new and some old.  Running the same upsert again heals that, as
every rule here gives the same state when it is applied twice.  One writer at a time; readers of one
place during its move may have to retry.  Where that isn't enough, use a catalog with ``MERGE`` (``catalog.merge``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.dedup import latest_per_key
from strata.operators.upsert import insert_if_absent, upsert, upsert_columns
from strata.session import materialize
from strata.sources.tables import _FS, bucket_of

PLACE = "_place"
#: text bytes of one place: a task rewrites a place whole
PLACE_BYTES = 512 << 20


def buckets_for(total_bytes: int, place_bytes: int = PLACE_BYTES, least: int = 1) -> int:
    """Buckets from the table's size (its expected size, for a table that grows)."""
    return max(least, -(-total_bytes // place_bytes))


def offset_ranges(width: int) -> Column:
    """Place of a message: topic, partition and range of ``width`` offsets.  New messages
    go to the newest ranges, replayed ones to the ranges that hold their first copies."""
    number = F.floor(F.col("kafka_offset") / F.lit(width)).cast("string")
    return F.concat_ws("-", F.coalesce(F.col("kafka_topic"), F.lit("")), F.coalesce(F.col("kafka_partition").cast("string"), F.lit("")),
                       F.coalesce(number, F.lit("")))


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 16, place: Column | None = None):
        """``place`` (a function of the keys) replaces the hash buckets."""
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.place = bucket_of(self.keys, buckets) if place is None else place
        self._fs = _FS(spark, path)

    # ---------------------------------------------------------------- reads
    def exists(self) -> bool:
        return any(n.startswith(f"{PLACE}=") for n in self._fs.list_names(self.path))

    def _scan(self) -> DataFrame:
        # the types of all columns but the place come from the files
        return self.spark.read.parquet(self.path)

    def read(self) -> DataFrame:
        return self._scan().drop(PLACE)

    def read_places(self, places: Sequence) -> DataFrame:
        """Rows of some places: the filter is on the partition column, so other places are not read."""
        return self._scan().filter(F.col(PLACE).isin(*places)).drop(PLACE)

    # --------------------------------------------------------------- writes
    def _write(self, df: DataFrame, mode: str = "dynamic") -> None:
        placed = df.withColumn(PLACE, self.place)
        # rows of one place meet in one task, so a place is one file
        (placed.repartition(F.col(PLACE)).write.mode("overwrite").option("partitionOverwriteMode", mode)
         .partitionBy(PLACE).parquet(self.path))

    def overwrite(self, df: DataFrame) -> None:
        """Publish ``df`` as the whole table."""
        self._write(df, "static")

    def change(self, updates: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> list:
        """Replace the places of ``updates`` by ``combine(their rows, updates)``; returns them.
        Their number is bounded by the table's partitions.  The rule must leave rows in every place (``delete`` is the one that
        doesn't).  Columns that only the updates have are added, NULL in older rows."""
        staged = materialize(updates, "keyed-updates")
        places = [r[0] for r in staged.select(self.place.alias(PLACE)).distinct().collect()]
        if not places:
            return []
        if not self.exists():
            self._write(combine(staged.limit(0), staged))
            return places
        target = self.read_places(places)
        added = [f for f in staged.schema.fields if f.name not in target.columns]
        target = target.withColumns({f.name: F.lit(None).cast(f.dataType) for f in added}) if added else target
        staged = staged.withColumns({f.name: F.lit(None).cast(f.dataType) for f in target.schema.fields if f.name not in staged.columns})
        # a key of another integer type would hash to another place
        staged = staged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])
        self._write(combine(target, staged))
        return places

    def upsert(self, updates: DataFrame, order: Sequence[str | Column] | None = None) -> list:
        """MERGE by key (I4): with ``order`` the newest row wins whichever side it is on, without it
        the update's row.  Repeated update keys raise without an order."""
        first = None if order is None else list(order)
        return self.change(updates, lambda t, u: upsert(t, u, self.keys, first))

    def upsert_columns(self, updates: DataFrame, columns: Sequence[str]) -> list:
        """INSERT ... ON CONFLICT (keys) DO UPDATE SET columns."""
        return self.change(updates, lambda t, u: upsert_columns(t, u, self.keys, columns))

    def insert_if_absent(self, rows: DataFrame, order: Sequence[str | Column]) -> list:
        """INSERT ... ON CONFLICT DO NOTHING (I10); among new rows of one key the first under ``order``."""
        return self.change(rows, lambda t, u: insert_if_absent(t, u, self.keys, list(order)))

    def keep_first(self, rows: DataFrame, order: Sequence[str | Column]) -> list:
        """One row per key, the first under ``order`` of all that ever came."""
        return self.change(rows, lambda t, u: latest_per_key(t.unionByName(u), self.keys, list(order)))

    def delete(self, keys: DataFrame) -> list:
        """Remove the rows of these keys."""
        if not self.exists():
            return []
        staged = materialize(keys.select(*self.keys).distinct(), "keyed-deletes")
        places = [r[0] for r in staged.select(self.place.alias(PLACE)).distinct().collect()]
        kept = materialize(self.read_places(places).join(staged, self.keys, "left_anti"), "keyed-kept")
        left = {r[0] for r in kept.select(self.place.alias(PLACE)).distinct().collect()}
        if left:
            self._write(kept)
        for gone in set(places) - left:  # nothing is written for a place without rows, so Spark leaves its old ones
            self._fs.delete(f"{self.path}/{PLACE}={gone}")
        return places

