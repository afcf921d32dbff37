"""What streaming queries report of themselves (K7): offsets, rows and lag per batch, failures.

A ``StreamingQueryListener`` gets every finished batch of every query of the session.  Its reports are metadata, one for a
batch and source, and go to a bounded list; ``frame`` makes them rows.
"""

from __future__ import annotations

import json
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = ("name string, run string, batch long, source string, rows long, start_offset string, end_offset string, "
          "latest_offset string, late_rows long, state_rows long")


def partition_lag(end: str | None, latest: str | None) -> int | None:
    """Messages between two Kafka offset texts, ``{"topic": {"0": 17}}``, over all partitions; None where
    a source gives no such offsets."""
    try:
        a, b = json.loads(end), json.loads(latest)
        return sum(n - a.get(t, {}).get(p, 0) for t, ps in b.items() for p, n in ps.items())
    except (TypeError, ValueError, AttributeError):
        return None


class ProgressLog(StreamingQueryListener):
    """Progress of the session's queries since ``attach``."""

    def __init__(self, keep: int = 10_000):
        self.reports: deque = deque(maxlen=keep)
        self.failures: dict[str, str] = {}
        self.ended: set[str] = set()
        self._names: dict[str, str] = {}

    def attach(self, spark: SparkSession) -> ProgressLog:
        spark.streams.addListener(self)
        return self

    def detach(self, spark: SparkSession) -> None:
        spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self._names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        held = sum(s.numRowsTotal for s in p.stateOperators)
        for s in p.sources:
            self.reports.append((p.name, str(p.runId), int(p.batchId), s.description, int(s.numInputRows),
                                 s.startOffset, s.endOffset, s.latestOffset, int(late), int(held)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))
        if event.exception:
            self.failures[self._names.get(str(event.runId), "")] = str(event.exception).split("\n", 1)[0]

    def frame(self, spark: SparkSession) -> DataFrame:
        """A row for every batch and source."""
        return spark.createDataFrame(list(self.reports), SCHEMA)

    def lag(self, spark: SparkSession) -> DataFrame:
        """name, batch, rows so far and messages behind the source after each query's newest batch (null where the
        source has no per-partition offsets)."""
        newest: dict[str, tuple] = {}
        total: dict[str, int] = {}
        for r in self.reports:
            total[r[0]] = total.get(r[0], 0) + r[4]
            newest[r[0]] = r
        rows = [(n, r[2], total[n], partition_lag(r[6], r[7])) for n, r in newest.items()]
        return spark.createDataFrame(rows, "name string, batch long, rows long, lag long")


def unread(bronze: DataFrame, landed: DataFrame) -> DataFrame:
    """Lag from the data: per topic and partition the source's and the landed messages' newest offset, and how many messages of
    the source lie after the latter."""
    key = ["kafka_topic", "kafka_partition"]
    done = landed.groupBy(*key).agg(F.max("kafka_offset").alias("landed_offset"), F.count(F.lit(1)).alias("landed"))
    return (bronze.join(done, key, "left")
            .groupBy(*key).agg(F.max("kafka_offset").alias("source_offset"), F.first("landed_offset").alias("landed_offset"),
                               F.coalesce(F.first("landed"), F.lit(0)).alias("landed"),
                               F.count_if(F.col("landed_offset").isNull() | (F.col("kafka_offset") > F.col("landed_offset"))).alias("lag")))
