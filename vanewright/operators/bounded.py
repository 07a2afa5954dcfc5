"""Joining a large table to a result that is expected to be small, with the size checked first."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

MAX_ROWS = 100_000
MAX_BYTES = 32 * 1024 * 1024


def rows_if_small(df: DataFrame, max_rows: int = MAX_ROWS) -> list[Row] | None:
    """The rows of ``df`` if there are at most ``max_rows``, else None. Never fetches more than one row over."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def join_small(
    big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", max_rows: int = MAX_ROWS
) -> DataFrame:
    """Join with ``small`` broadcast if it passes the size check, else as a plain join.

    Meant for derived one-row-per-class results (thresholds, totals): the broadcast spares ``big`` a shuffle by a
    class column, where a single class may hold a large share of the rows. Past the bound the join is left to
    adaptive execution, which splits skewed partitions.
    """
    rows = rows_if_small(small, max_rows)
    if rows is None or sum(len(str(v)) for row in rows for v in row) > MAX_BYTES:
        return big.join(small, on, how)
    local = big.sparkSession.createDataFrame(rows, small.schema)
    return big.join(F.broadcast(local), on, how)
