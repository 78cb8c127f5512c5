"""RANK windows.

Every rank in the reference is computed on aggregated rows whose count is
bounded by dimension sizes (zones x months, 24 hours, zones x payment types x
buckets), never on trip rows; an un-partitioned window (a single-partition
exchange) is only used on such bounded inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from farebox.functions.util import as_col


def _rank(order: Column, partition_by: list[str] | None) -> Column:
    w = Window.partitionBy(*partition_by).orderBy(order) if partition_by else Window.orderBy(order)
    return F.rank().over(w)


def rank_desc(order_col, partition_by: list[str] | None = None) -> Column:
    """RANK() OVER ([PARTITION BY ...] ORDER BY x DESC): ties share a rank,
    the next rank skips."""
    return _rank(as_col(order_col).desc(), partition_by)


def rank_asc(order_col, partition_by: list[str] | None = None) -> Column:
    return _rank(as_col(order_col).asc(), partition_by)
