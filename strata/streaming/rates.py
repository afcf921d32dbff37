"""Streaming rate that loses no late row (K6).

A watermark bounds the state of a windowed count by dropping rows that come later than it allows.  Here the
windows live in a table instead: a batch counts its own rows per window and writes them as the batch's contribution, one small
partition that a replay replaces.  A window's count is the sum of its contributions, so a row is counted however late it comes, nothing
is kept in memory between batches, and no row is counted twice.

How many rows were behind the watermark is counted beside it: a contribution tells rows that came
more than ``lateness`` after the newest event time of the batches before.  That is what a watermark of that length would have dropped.

Each batch leaves one file of as many rows as it has windows, so the trigger should be minutes rather than seconds, and a reader
of a long history sums many small files.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.functions.time import truncate, ts_literal
from strata.sources.landing import BATCH, batch_name, run_of
from strata.sources.tables import _FS


class RateTable:
    """Counts per window, by contribution."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = _FS(spark, path)

    def contributions(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def add(self, counts: DataFrame, run: str, number: int) -> None:
        (counts.withColumn(BATCH, F.lit(batch_name(run, number))).coalesce(1).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(self.path))

    def rate(self) -> DataFrame:
        """minute, events: all rows that ever came."""
        return self.contributions().groupBy("minute").agg(F.sum("events").alias("events"))

    def accounted(self) -> DataFrame:
        """minute, events, late_events (of those, how many came behind the watermark)."""
        return self.contributions().groupBy("minute").agg(F.sum("events").alias("events"), F.sum("late_events").alias("late_events"))

    def newest_before(self, run: str, number: int):
        """Newest event time of the run's batches before ``number``: a replay gets the same answer."""
        path = f"{self.path}/_newest/{run}.json"
        if not self._fs.exists(path):
            return None
        seen = json.loads(self._fs.read_text(path))
        return max((t for n, t in seen if n < number and t), default=None)

    def set_newest(self, run: str, number: int, newest) -> None:
        path = f"{self.path}/_newest/{run}.json"
        seen = json.loads(self._fs.read_text(path)) if self._fs.exists(path) else []
        # the newest time over all batches before this one, and this one's
        before = max((t for n, t in seen if n < number and t), default=None)
        self._fs.write_text(path, json.dumps([(number - 1, before), (number, str(newest) if newest else None)]))


def counted(batch: DataFrame, ts: str, unit: str, behind=None) -> DataFrame:
    """minute, events, late_events, newest of one batch: one aggregate."""
    late = F.col(ts) < behind if behind is not None else F.lit(False)
    return batch.groupBy(truncate(unit, ts).alias("minute")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(late).alias("late_events"), F.max(ts).alias("newest"))


def start_exact_rate(stream: DataFrame, table: RateTable, ts: str, checkpoint: str, name: str, unit: str = "minute",
                     lateness: str = "10 MINUTES", trigger: dict | None = None) -> StreamingQuery:
    """Maintain counts per window of ``unit`` in ``table``, late rows included and counted."""
    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_of(table.spark, checkpoint)
        seen = table.newest_before(run, batch_id)
        behind = None if seen is None else ts_literal(seen) - F.expr(f"INTERVAL {lateness}")
        table.add(counted(batch, ts, unit, behind), run, batch_id)
        own = table.contributions().filter(F.col(BATCH) == batch_name(run, batch_id))  # this batch's few rows
        table.set_newest(run, batch_id, own.agg(F.max("newest")).first()[0])

    return (stream.writeStream.queryName(name).option("checkpointLocation", checkpoint)
            .foreachBatch(write).trigger(**(trigger or {"processingTime": "1 minute"})).start())
