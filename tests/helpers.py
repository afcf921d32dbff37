"""Helpers that several test modules share."""

from datetime import datetime

SF_SMALL = "/root/testdata/sf0.001"


def ts(second: int, micro: int = 0) -> datetime:
    return datetime(2026, 1, 1, 0, 0, second, micro)


def bronze_rows(spark, topic, payloads, seconds):
    """Bronze frame from (offset, second) positions: partition 0, kafka_ts =
    ingested_at, as in FIXTURES.md."""
    from strata.schemas import BRONZE_SCHEMA

    rows = [(p, topic, 0, i, ts(s), ts(s)) for i, (p, s) in enumerate(zip(payloads, seconds))]
    return spark.createDataFrame(rows, BRONZE_SCHEMA)
