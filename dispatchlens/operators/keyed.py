"""Joins to small tables of proven size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_months(frame: DataFrame, rows_bound: int, limit: int = 12_000) -> DataFrame:
    """Broadcast a table that provably has at most ``rows_bound`` rows.

    Used for tables with a few rows per analysed month.  Past ``limit`` (a
    thousand years of months) the frame stays unhinted and Spark chooses.
    """
    return F.broadcast(frame) if rows_bound <= limit else frame
