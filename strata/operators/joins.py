"""Broadcasts behind a check of their size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# About 40 MB of dimension rows; larger sides are shuffled.
BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, counted: DataFrame | None = None, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else unchanged.

    ``counted`` may name a cheaper table with at least as many rows, such as the
    stored table ``df`` is derived from: counting that reads file footers only.
    """
    return F.broadcast(df) if is_small(df if counted is None else counted, rows) else df


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether the table has at most ``rows`` rows."""
    return df.count() <= rows
