"""Streams into landing-day Bronze, with bounded batches (A4, K1, K2), and into keyed tables.

``foreachBatch`` may run a batch again: after a failure between its write and the checkpoint's commit, the restarted query
gets the same rows under the same number.  Landing replaces the batch's own folders, the keyed rules give the
same state twice, so either way each message counts once.

How much a batch takes is the source's option: ``maxFilesPerTrigger`` / ``maxBytesPerTrigger`` for files,
``maxOffsetsPerTrigger`` for Kafka.  With ``{"availableNow": True}`` a backlog is worked off in batches of that size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators.dedup import drop_duplicate_messages
from strata.sources.bronze import select_bronze
from strata.sources.keyed import KeyedTable, offset_ranges
from strata.sources.landing import LandedTable, run_of
from strata.schemas import MESSAGE_ID

#: offsets of one partition in one place of a deduplicated table
RANGE = 1_000_000


def land_batches(table: LandedTable, checkpoint: str, after: Callable[[int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body.  ``after(batch_id)`` runs between the write and the checkpoint's commit
    (tests make it fail there)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table.land(batch, run_of(table.spark, checkpoint), batch_id)
        if after is not None:
            after(batch_id)

    return write


def _start(stream: DataFrame, body, checkpoint: str, name: str, trigger: dict | None, default: dict) -> StreamingQuery:
    return (stream.writeStream.queryName(name).option("checkpointLocation", checkpoint)
            .foreachBatch(body).trigger(**(trigger or default)).start())


def start_landing(stream: DataFrame, table: LandedTable, checkpoint: str, name: str, trigger: dict | None = None,
                  after: Callable[[int], None] | None = None) -> StreamingQuery:
    """Land a Bronze-projected stream by landing day."""
    return _start(select_bronze(stream), land_batches(table, checkpoint, after), checkpoint, name, trigger, {"processingTime": "30 seconds"})


def start_landing_topics(spark: SparkSession, streams: dict[str, DataFrame], tables: dict[str, LandedTable], checkpoint_root: str,
                         trigger: dict | None = None, after: dict[str, Callable[[int], None]] | None = None) -> dict[str, StreamingQuery]:
    """One query and one checkpoint per topic in one application (A2, K3): a topic that fails leaves the others running."""
    out = {}
    for topic, stream in streams.items():
        name = "land_" + "".join(ch if ch.isalnum() else "_" for ch in topic)
        out[topic] = start_landing(stream, tables[topic], f"{checkpoint_root}/{name}", name, trigger, (after or {}).get(topic))
    return out


def dedup_table(spark: SparkSession, path: str, width: int = RANGE) -> KeyedTable:
    """Messages by identity, placed by topic, partition and range of offsets."""
    return KeyedTable(spark, path, MESSAGE_ID, place=offset_ranges(width))


def start_range_dedup(stream: DataFrame, table: KeyedTable, checkpoint: str, name: str, trigger: dict | None = None,
                      first_by: str = "ingested_at", touched: Callable[[int, list], None] | None = None) -> StreamingQuery:
    """Land each message once (K4): the earliest landed copy of every identity, however late it or another copy comes.

    A batch reads and rewrites the offset ranges it has messages of: the newest ones, and for replayed messages
    those of their first copies.  So its cost follows the batch and the width of a range, not the history."""
    def write(batch: DataFrame, batch_id: int) -> None:
        places = table.keep_first(drop_duplicate_messages(batch, first_by=first_by), [F.col(first_by).asc_nulls_last()])
        if touched is not None:
            touched(batch_id, places)

    return _start(select_bronze(stream), write, checkpoint, name, trigger, {"processingTime": "1 minute"})
