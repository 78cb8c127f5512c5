"""Scalar expression helpers (Catalyst expressions only)."""

from farebox.functions.labels import distance_bucket, period_label
from farebox.functions.numeric import (
    PARTS, exact_avg, exact_sum, from_parts, guarded_ratio, round2, sum_parts, to_int,
)
from farebox.functions.temporal import (
    day_name, elapsed_minutes, elapsed_seconds, hour_part, is_weekend,
    minute_boundaries, month_number, month_start, pickup_date, year_part,
)

__all__ = [
    "day_name", "distance_bucket", "elapsed_minutes", "elapsed_seconds",
    "PARTS", "exact_avg", "exact_sum", "from_parts", "guarded_ratio", "hour_part",
    "is_weekend", "sum_parts",
    "minute_boundaries", "month_number", "month_start", "period_label",
    "pickup_date", "round2", "to_int", "year_part",
]
