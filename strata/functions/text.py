"""String normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: str | Column) -> Column:
    """Strip leading/trailing spaces (spaces only, like SQL TRIM)."""
    return F.trim(_col(c))


def norm(c: str | Column) -> Column:
    """Case-folded, trimmed key text (e-mail, username, gender)."""
    return F.lower(F.trim(_col(c)))


def concat_skip_nulls(sep: str, *cols: str | Column) -> Column:
    """NULL-skipping join; two NULLs give '' (not NULL)."""
    return F.concat_ws(sep, *[_col(c) for c in cols])


def concat_nullable(sep: str, *cols: str | Column) -> Column:
    """NULL-propagating join (the SQL CONCAT variant)."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_col(c))
    return F.concat(*parts)


def label_unknown(c: str | Column, label: str = "unknown") -> Column:
    """Default label for a missing category."""
    return F.coalesce(_col(c), F.lit(label))
