"""Structured Streaming: Bronze ingest, Silver upsert, windowed rates."""

from strata.streaming.ingest import append_batches, start_bronze, start_topics
from strata.streaming.landing import start_landing, start_landing_topics, start_range_dedup
from strata.streaming.progress import ProgressLog, unread
from strata.streaming.rates import RateTable, start_exact_rate
from strata.streaming.upsert_stream import merge_batches, start_rate, start_upsert, windowed_counts

__all__ = [
    "ProgressLog",
    "RateTable",
    "append_batches",
    "merge_batches",
    "start_bronze",
    "start_exact_rate",
    "start_landing",
    "start_landing_topics",
    "start_range_dedup",
    "start_rate",
    "start_topics",
    "start_upsert",
    "unread",
    "windowed_counts",
]
