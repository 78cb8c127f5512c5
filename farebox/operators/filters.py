"""Row filters used by the marts, the daily job and the reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def positive_total(df: DataFrame, col: str = "total_amount") -> DataFrame:
    """total > 0: drops NULL, zero and refunds (negative totals)."""
    return df.filter(F.col(col) > 0)


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def rank_at_most(df: DataFrame, rank_col: str, k: int) -> DataFrame:
    """Top-k by a rank column, ties included."""
    return df.filter(F.col(rank_col) <= k)


def either_rank_at_most(df: DataFrame, rank_a: str, rank_b: str, k: int) -> DataFrame:
    return df.filter((F.col(rank_a) <= k) | (F.col(rank_b) <= k))


def min_support(df: DataFrame, count_col: str, minimum: int) -> DataFrame:
    return df.filter(F.col(count_col) >= minimum)
