"""Pure Column helpers.  Every helper returns a Column built from built-in
Spark functions, so it stays inside whole-stage codegen (no Python UDF)."""

from strata.functions.jsonpath import (
    json_first,
    json_path,
    parse_struct,
    to_payload,
)
from strata.functions.text import clean, concat_nullable, concat_skip_nulls, label_unknown, norm
from strata.functions.time import (
    EPOCH_NTZ,
    add_interval,
    millis_since_epoch,
    minute_bucket,
    ms_to_ts,
    older_than,
    to_millis_precision,
    truncate,
    year_of,
)

__all__ = [
    "EPOCH_NTZ",
    "add_interval",
    "millis_since_epoch",
    "clean",
    "concat_nullable",
    "concat_skip_nulls",
    "json_first",
    "json_path",
    "label_unknown",
    "minute_bucket",
    "ms_to_ts",
    "norm",
    "older_than",
    "parse_struct",
    "to_millis_precision",
    "to_payload",
    "truncate",
    "year_of",
]
