"""Rows dealt out into parts that do not grow with the table, so that neither does what a task holds."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows to a part.
PART_ROWS = 500_000


def parts(df: DataFrame, rows: int) -> int:
    """How many parts so many rows are dealt out into; no fewer than there are cores."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // PART_ROWS))
