"""Time helpers.

Timestamps are kept zone-less (TIMESTAMP_NTZ) end to end, so results never
depend on the session time zone.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


EPOCH_NTZ = "1970-01-01 00:00:00"


def ms_to_ts(ms: str | Column) -> Column:
    """Epoch milliseconds to a zone-less timestamp (exact, no float step)."""
    return F.timestamp_add("MILLISECOND", _col(ms), F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def year_of(text: str | Column) -> Column:
    """Leading four-digit year of a date-ish text, else NULL.

    Guarded by a regex so that '1_99', '19.5', 'n/a' or an object's JSON text
    give NULL on every engine instead of an error or a lenient parse.
    """
    head = F.substring(_col(text), 1, 4)
    return F.when(head.rlike("^[0-9]{4}$"), head.try_cast("int"))


def truncate(unit: str, ts: str | Column) -> Column:
    """DATE_TRUNC on a zone-less timestamp, staying zone-less.

    Spark's ``date_trunc`` answers with a zoned TIMESTAMP; truncating happens on
    the session wall clock, so casting back gives the zone-less wall time.
    """
    return F.date_trunc(unit, _col(ts)).cast("timestamp_ntz")


def minute_bucket(ts: str | Column) -> Column:
    return truncate("minute", ts)


def to_millis_precision(ts: str | Column) -> Column:
    """TIMESTAMP(3): drop sub-millisecond digits, zone-less."""
    return truncate("millisecond", ts)


def add_interval(ts: str | Column, unit: str, amount: int | Column) -> Column:
    """ts + amount units, keeping the timestamp type (TIMESTAMPADD)."""
    qty = amount if isinstance(amount, Column) else F.lit(amount)
    return F.timestamp_add(unit, qty, _col(ts))


def millis_since_epoch(ts: str | Column) -> Column:
    """Zone-less timestamp to epoch milliseconds (inverse of ``ms_to_ts``)."""
    return F.timestamp_diff("MILLISECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), _col(ts))


def older_than(ts: str | Column, interval: str) -> Column:
    """Relative cutoff, e.g. ``older_than('committed_at', '7 days')``."""
    return _col(ts) < (F.localtimestamp() - F.expr(f"INTERVAL {interval}"))


def ts_literal(value, dtype="timestamp_ntz") -> Column:
    """A timestamp literal that means the same in every session zone.

    ``F.lit(datetime)`` reads a naive datetime on the Python process clock
    and a later cast re-reads it on the session clock, so the two zones
    disagreeing shifts the value.  A naive datetime or a string goes in as
    text and is cast once; an aware datetime keeps its own zone.
    """
    if isinstance(value, datetime) and value.tzinfo is None:
        return F.lit(value.isoformat(sep=" ")).cast(dtype)
    return F.lit(value).cast(dtype)
