"""Streaming Bronze ingest (A2, A4, K1-K3).

Each micro-batch is appended to a versioned Bronze table as one commit that
carries ``<query id>:<batch id>``; a replayed batch (``foreachBatch`` is
at-least-once) finds its id already committed and is skipped, which gives
exactly-once Bronze on top of the stream checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata.sources.bronze import select_bronze
from strata.sources.tables import VersionedTable

DEFAULT_TRIGGER = {"processingTime": "30 seconds"}


def append_batches(table: VersionedTable, query_name: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: one idempotent append per micro-batch.  An
    empty micro-batch (an idle trigger, or the no-data batch that advances a
    watermark) commits nothing, so idle topics do not grow the log; its
    replay is empty again, so skipping it keeps exactly-once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        txn = f"{query_name}:{batch_id}"
        if table.committed_txn(txn):
            return
        table.append(batch, skip_empty=True, txn=txn)

    return write


def start_bronze(stream: DataFrame, table: VersionedTable, checkpoint: str, query_name: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """Land a Kafka-shaped (already Bronze-projected) stream into ``table``.

    ``trigger`` defaults to a 30 s processing-time cadence; pass
    ``{"availableNow": True}`` for a catch-up run that stops when drained.
    """
    writer = (
        select_bronze(stream)
        .writeStream.queryName(query_name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(append_batches(table, query_name))
    )
    writer = writer.trigger(**(trigger or DEFAULT_TRIGGER))
    return writer.start()


def start_topics(spark: SparkSession, streams: dict[str, DataFrame], tables: dict[str, VersionedTable],
                 checkpoint_root: str, trigger: dict | None = None) -> dict[str, StreamingQuery]:
    """Several independent ingest queries in one application (A2, K3): one
    query and one checkpoint per topic, so a stuck topic never blocks another."""
    out = {}
    for topic, stream in streams.items():
        name = "bronze_" + "".join(ch if ch.isalnum() else "_" for ch in topic)
        out[topic] = start_bronze(stream, tables[topic], f"{checkpoint_root}/{name}", name, trigger)
    return out


def await_all(queries: dict[str, StreamingQuery]) -> None:
    for q in queries.values():
        q.awaitTermination()
