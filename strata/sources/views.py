"""Views: mix DataFrames and SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def register_views(frames: dict[str, DataFrame], unique: bool = True) -> dict[str, str]:
    """Register each frame as a session temp view (no copy).

    With ``unique`` the view names get a random suffix so concurrent jobs in
    one session never see each other's views; the returned mapping gives the
    name to use in SQL.
    """
    names = {}
    for name, df in frames.items():
        view = f"{name}_{uuid.uuid4().hex[:8]}" if unique else name
        df.createOrReplaceTempView(view)
        names[name] = view
    return names
