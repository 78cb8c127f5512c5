"""CASE-style labels used by the marts and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farebox.functions.util import as_col

# Distance buckets, half-open upper bounds in miles.
DISTANCE_BUCKETS = [
    (1, "0-1 miles"),
    (3, "1-3 miles"),
    (5, "3-5 miles"),
    (10, "5-10 miles"),
]
DISTANCE_BUCKET_ELSE = "10+ miles"

# Demand period labels and the rank cut-off.
PEAK_LABEL = "Peak period"
TROUGH_LABEL = "Trough period"
NORMAL_LABEL = "Normal period"
PERIOD_RANK_CUTOFF = 3


def distance_bucket(distance) -> Column:
    """First bucket whose bound exceeds the distance; NULL falls to the ELSE
    label, as a CASE without an IS NULL branch does."""
    d = as_col(distance)
    expr = None
    for bound, label in DISTANCE_BUCKETS:
        expr = F.when(d < bound, label) if expr is None else expr.when(d < bound, label)
    return expr.otherwise(DISTANCE_BUCKET_ELSE)


def period_label(peak_rank, trough_rank, cutoff: int = PERIOD_RANK_CUTOFF) -> Column:
    """Peak wins over trough when an hour qualifies for both."""
    return (
        F.when(as_col(peak_rank) <= cutoff, PEAK_LABEL)
        .when(as_col(trough_rank) <= cutoff, TROUGH_LABEL)
        .otherwise(NORMAL_LABEL)
    )
