"""Bronze by landing day, on Spark's own partitioned writer.

Rows are written to ``landed_on=<day>/batch=<run and number>/``.  Both are partition columns, so a time window reads the folders
of its days and a consumer's slice those of the batches it hasn't seen: partition filters, no scan of older files.

* A batch is written with dynamic partition overwrite, so a batch that is replayed replaces its own
  folders and nothing else: each message once, without a log.
* A batch's name is the streaming query's id (from its checkpoint) and the batch number, so a new checkpoint
  can't overwrite the batches of an old one.
* Rows that land late go to the folder of their old day, under the batch that brought them, so a consumer that follows batches
  gets them although their day is long past.
* A consumer's mark is the newest batch number it has consumed of each run: a few numbers.
* Each batch adds a folder for every day it has rows of: choose the trigger so that a batch is worth a file.
"""

from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.time import ts_literal
from strata.sources.bronze import select_bronze
from strata.sources.tables import _FS

DAY, BATCH = "landed_on", "batch"
#: rows without a landing time
NO_DAY = date(1970, 1, 1)
_DIGITS = 12


def batch_name(run: str, number: int) -> str:
    return f"{run}.{number:0{_DIGITS}d}"


class LandedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = _FS(spark, path)

    def exists(self) -> bool:
        return any(n.startswith(f"{DAY}=") for n in self._fs.list_names(self.path))

    # --------------------------------------------------------------- writes
    def land(self, rows: DataFrame, run: str, number: int) -> None:
        """Write one batch; the same batch again replaces itself."""
        placed = select_bronze(rows).withColumn(DAY, F.coalesce(F.to_date("ingested_at"), F.lit(NO_DAY))).withColumn(
            BATCH, F.lit(batch_name(run, number)))
        (placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, BATCH).parquet(self.path))

    # ---------------------------------------------------------------- reads
    def _scan(self) -> DataFrame:
        # the day's text is a date; a batch's name stays text
        return self.spark.read.option("basePath", self.path).parquet(self.path).withColumn(BATCH, F.col(BATCH).cast("string"))

    def read(self) -> DataFrame:
        return self._scan().drop(DAY, BATCH)

    def window(self, since: datetime | str, until: datetime | str | None = None) -> DataFrame:
        """Rows that landed at or after ``since`` (and before ``until``): the days are a partition filter, the
        exact times a pushed one."""
        at = F.col("ingested_at")
        lo = ts_literal(since)
        rows = self._scan().filter((F.col(DAY) >= F.to_date(lo)) & (at >= lo))
        if until is not None:
            hi = ts_literal(until)
            rows = rows.filter((F.col(DAY) <= F.to_date(hi)) & (at < hi))
        return rows.drop(DAY, BATCH)

    def last_landed(self) -> datetime | None:
        """The newest landing time, from the newest day's folder alone."""
        days = [n.split("=", 1)[1] for n in self._fs.list_names(self.path) if n.startswith(f"{DAY}=")]
        if not days:
            return None
        return self._scan().filter(F.col(DAY) == F.lit(max(days)).cast("date")).agg(F.max("ingested_at")).first()[0]

    # ------------------------------------------------------------ consumers
    def heads(self) -> dict[str, int]:
        """The newest batch number of each run, from the names of the folders."""
        if not self.exists():
            return {}
        run, number = F.split_part(F.col(BATCH), F.lit("."), F.lit(1)), F.split_part(F.col(BATCH), F.lit("."), F.lit(2))
        got = self._scan().select(BATCH).distinct().groupBy(run.alias("run")).agg(F.max(number.cast("long")).alias("n")).collect()
        return {r["run"]: r["n"] for r in got}

    @staticmethod
    def _after(mark: dict[str, int], head: dict[str, int]) -> Column:
        """Batches after the mark, up to the head, as a filter on the partition column."""
        parts = [(F.col(BATCH) > F.lit(batch_name(run, mark[run]) if run in mark else f"{run}."))
                 & (F.col(BATCH) <= F.lit(batch_name(run, n))) for run, n in head.items() if n > mark.get(run, -1)]
        out = F.lit(False)
        for p in parts:
            out = p if out is None else out | p
        return out

    def since(self, mark: dict[str, int] | None) -> tuple[DataFrame | None, dict[str, int]]:
        """(rows of the batches after ``mark``, the mark after them); None for no new batch.  Without a mark: everything."""
        head = self.heads()
        if mark is None:
            return (self.read() if self.exists() else None), head
        if all(n <= mark.get(run, -1) for run, n in head.items()):
            return None, mark
        return self._scan().filter(self._after(mark, head)).drop(DAY, BATCH), {**mark, **head}

    def mark_of(self, consumer: str) -> dict[str, int] | None:
        path = f"{self.path}/_marks/{consumer}.json"
        return json.loads(self._fs.read_text(path)) if self._fs.exists(path) else None

    def set_mark(self, consumer: str, mark: dict[str, int]) -> None:
        """Called after the consumer has published: a crash between both makes it read the slice again,
        which a guarded merge doesn't notice."""
        self._fs.write_text(f"{self.path}/_marks/{consumer}.json", json.dumps(mark))


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """Name of a streaming query's run: the id that its checkpoint keeps over restarts."""
    fs = _FS(spark, checkpoint)
    return "r" + json.loads(fs.read_text(f"{checkpoint.rstrip('/')}/metadata").strip())["id"].replace("-", "")


def consume(bronze: LandedTable, target, build, order, consumer: str) -> list:
    """One run of a Silver table (I2) over the batches it hasn't consumed: guarded upsert, then the mark."""
    rows, head = bronze.since(bronze.mark_of(consumer))
    if rows is None:
        return []
    places = target.upsert(build(rows), order)
    bronze.set_mark(consumer, head)
    return places
