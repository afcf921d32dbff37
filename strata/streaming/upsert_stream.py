"""Streaming Bronze -> Silver upsert (K5) and the streaming rate (K6).

Silver is maintained by ``foreachBatch``: every micro-batch is parsed,
deduplicated and merged (guarded) into the bucketed Silver table; the batch
id is committed with the data so replays are no-ops.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.functions.time import truncate
from strata.operators.dedup import drop_duplicate_messages
from strata.schemas import MESSAGE_ID
from strata.sources.tables import VersionedTable


def merge_batches(table: VersionedTable, build: Callable[[DataFrame], DataFrame], keys: Sequence[str],
                  order: Sequence[Column] | None, query_name: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        txn = f"{query_name}:{batch_id}"
        if table.committed_txn(txn):
            return
        table.merge(build(batch), list(keys), order, txn=txn)

    return write


def start_upsert(stream: DataFrame, table: VersionedTable, build: Callable[[DataFrame], DataFrame],
                 keys: Sequence[str], order: Sequence[Column] | None, checkpoint: str, query_name: str,
                 trigger: dict | None = None) -> StreamingQuery:
    writer = (
        stream.writeStream.queryName(query_name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(merge_batches(table, build, keys, order, query_name))
        .trigger(**(trigger or {"processingTime": "15 minutes"}))
    )
    return writer.start()


def start_dedup(stream: DataFrame, table: VersionedTable, checkpoint: str, query_name: str,
                trigger: dict | None = None, first_by: str = "ingested_at") -> StreamingQuery:
    """Land each message once (K4): a guarded merge on the message identity
    keeps the earliest landed copy.  No watermark: a first copy that comes late
    is kept however late it is, and any later copy changes nothing.  ``table`` is
    bucketed by the message identity, which is its state.  New messages are added to
    their buckets (``keep_first``), so a batch writes what it brings, not the table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        txn = f"{query_name}:{batch_id}"
        if table.committed_txn(txn):
            return
        table.keep_first(drop_duplicate_messages(batch, first_by=first_by), first_by, MESSAGE_ID, txn=txn)

    return (
        stream.writeStream.queryName(query_name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or {"processingTime": "15 minutes"}))
        .start()
    )


def windowed_counts(stream: DataFrame, ts: str, window: str = "1 minute",
                    watermark: str = "10 minutes", alias: str = "events") -> DataFrame:
    """Event-time counts per window with a watermark bounding the state (K6).

    Watermarks need a zoned TIMESTAMP: a zone-less event time is read on the
    session clock for the watermark and the window, and window starts are
    handed back zone-less.
    """
    ntz = isinstance(stream.schema[ts].dataType, T.TimestampNTZType)
    event = "_event_time"
    src = stream.withColumn(event, F.col(ts).cast("timestamp") if ntz else F.col(ts))
    start = F.col("w.start").cast("timestamp_ntz") if ntz else F.col("w.start")
    return (
        src.withWatermark(event, watermark)
        .groupBy(F.window(event, window).alias("w"))
        .agg(F.count(F.lit(1)).alias(alias))
        .select(start.alias("minute"), alias)
    )


def start_rate(stream: DataFrame, table: VersionedTable, ts: str, checkpoint: str, query_name: str,
               window: str = "1 minute", watermark: str = "10 minutes",
               trigger: dict | None = None) -> StreamingQuery:
    """Maintain per-window counts in ``table`` (keyed by window start).

    Update mode emits a window's running count each time it changes; the
    merge keeps the latest, so the table always holds current totals,
    including windows the watermark has not closed yet.
    """
    counts = windowed_counts(stream, ts, window, watermark)

    def write(batch: DataFrame, batch_id: int) -> None:
        txn = f"{query_name}:{batch_id}"
        if table.committed_txn(txn):
            return
        table.merge(batch, ["minute"], txn=txn)

    return (
        counts.writeStream.queryName(query_name)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


__all__ = [
    "merge_batches",
    "start_dedup",
    "start_rate",
    "start_upsert",
    "truncate",
    "windowed_counts",
]
