"""Schema-on-read helpers over a JSON text column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_path(payload: str | Column, path: str) -> Column:
    """Text at one JSON path; NULL when the path is absent or the text is not
    JSON.  Objects and numbers come back as their JSON text."""
    return F.get_json_object(_col(payload), path)


def json_first(payload: str | Column, *paths: str) -> Column:
    """Shape-tolerant field: the first non-NULL of several alternative paths
    (nested layout first, flat layout second)."""
    if not paths:
        raise ValueError("json_first needs at least one path")
    exprs = [json_path(payload, p) for p in paths]
    return exprs[0] if len(exprs) == 1 else F.coalesce(*exprs)


def parse_struct(payload: str | Column, schema: T.StructType) -> Column:
    """Parse with an explicit partial schema (PERMISSIVE: garbage gives a
    struct of NULLs, NULL/empty text gives NULL, wrong-typed leaves NULL)."""
    return F.from_json(_col(payload), schema)


def to_payload(*cols: str | Column) -> Column:
    """Object to JSON text; NULL fields are omitted, as a producer would."""
    return F.to_json(F.struct(*[_col(c) for c in cols]))
