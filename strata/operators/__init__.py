"""Row operators: dedup, upsert, incremental slices, rollups, quality."""

from strata.operators.dedup import (
    drop_duplicate_messages,
    duplicate_messages,
    latest_per_key,
    newest_first,
)
from strata.operators.incremental import (
    high_water_mark,
    incremental_slice,
    max_of,
    slice_after_target,
    table_mark,
)
from strata.operators.upsert import (
    DuplicateSourceKeys,
    assert_unique,
    insert_if_absent,
    live_rows,
    sync_columns,
    upsert,
    upsert_columns,
)

__all__ = [
    "DuplicateSourceKeys",
    "assert_unique",
    "drop_duplicate_messages",
    "duplicate_messages",
    "high_water_mark",
    "incremental_slice",
    "insert_if_absent",
    "latest_per_key",
    "live_rows",
    "max_of",
    "newest_first",
    "slice_after_target",
    "sync_columns",
    "table_mark",
    "upsert",
    "upsert_columns",
]
