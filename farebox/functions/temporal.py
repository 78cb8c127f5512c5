"""Date and time parts of a trip timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farebox.functions.util import as_col


def pickup_date(ts) -> Column:
    """Date part of the timestamp (CAST(ts AS DATE))."""
    return F.to_date(as_col(ts))


def month_start(ts) -> Column:
    """First day of the month as a DATE (the SQL models' pickup_month)."""
    return F.trunc(F.to_date(as_col(ts)), "MM")


def year_part(ts) -> Column:
    return F.year(as_col(ts))


def month_number(ts) -> Column:
    """Month 1..12 as an integer (the historical job's pickup_month)."""
    return F.month(as_col(ts))


def hour_part(ts) -> Column:
    return F.hour(as_col(ts))


def day_name(ts) -> Column:
    """Three-letter English day name: Sun, Mon, ..."""
    return F.dayname(as_col(ts))


def is_weekend(ts) -> Column:
    """TRUE on Saturday and Sunday; FALSE otherwise, including a NULL
    timestamp (the CASE ... ELSE FALSE of the model)."""
    # Spark numbers days 1 = Sunday .. 7 = Saturday.
    return F.when(F.dayofweek(as_col(ts)).isin(1, 7), F.lit(True)).otherwise(F.lit(False))


def _epoch_seconds(ts) -> Column:
    # Whole seconds since the epoch of the wall-clock value (sub-second
    # digits dropped), identical for TIMESTAMP and TIMESTAMP_NTZ under UTC.
    return F.unix_timestamp(as_col(ts))


def minute_boundaries(start, end) -> Column:
    """Signed number of minute boundaries crossed from ``start`` to ``end``.

    10:00:59 -> 10:01:00 is 1 and the reverse -1; this is DATEDIFF(minute)
    of a warehouse, not the elapsed whole minutes of ``timestampdiff``.
    """
    return F.floor(_epoch_seconds(end) / 60) - F.floor(_epoch_seconds(start) / 60)


def elapsed_seconds(start, end) -> Column:
    return _epoch_seconds(end) - _epoch_seconds(start)


def elapsed_minutes(start, end) -> Column:
    """Fractional elapsed minutes, (unix seconds difference) / 60."""
    return elapsed_seconds(start, end) / 60
