"""The three marts over the enriched trips.

Each is one hash aggregation: partial aggregation on the map side (so a hot
key costs one row per task), one shuffle on the grouping keys, final merge.
The output size is bounded by dimension cardinalities, not by trip volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox import functions as fx
from farebox.operators.filters import not_null, positive_total
from farebox.operators.windows import rank_desc


def zone_revenue(enriched: DataFrame) -> DataFrame:
    """Month x pickup location x borough x zone: trips, revenue, average
    revenue, and the revenue rank within the month.

    The rank orders by the unrounded revenue, an exact sum, so ties and order
    do not depend on partitioning. Averages are exact
    sums over counts, rounded half-up.
    """
    base = not_null(positive_total(enriched), "pickup_month")
    agg = base.groupBy("pickup_month", "pu_location_id", "pickup_borough", "pickup_zone").agg(
        F.count(F.lit(1)).alias("trip_count"),
        fx.exact_sum("total_amount").alias("_revenue"),
        fx.exact_avg("total_amount").alias("_avg_revenue"),
    )
    return agg.select(
        "pickup_month", "pu_location_id", "pickup_borough", "pickup_zone", "trip_count",
        fx.round2("_revenue").alias("total_revenue"),
        fx.round2("_avg_revenue").alias("avg_trip_revenue"),
        rank_desc("_revenue", ["pickup_month"]).alias("monthly_revenue_rank"),
    )


def demand_timing(enriched: DataFrame) -> DataFrame:
    """Hour x day name x weekend flag: trips and average fares."""
    return positive_total(enriched).groupBy("pickup_hour", "pickup_day_name", "is_weekend").agg(
        F.count(F.lit(1)).alias("trip_count"),
        fx.round2(fx.exact_avg("fare_amount")).alias("avg_fare_amount"),
        fx.round2(fx.exact_avg("total_amount")).alias("avg_total_amount"),
    )


def tip_behaviour(enriched: DataFrame) -> DataFrame:
    """Pickup location x borough x zone x payment type x distance bucket."""
    # tip_percentage is NULL exactly when total_amount <= 0 (or NULL) or
    # tip_amount is NULL, so with total > 0 already required the cheap
    # predicate below equals "tip_percentage IS NOT NULL". Filtering on the
    # derived column itself would make Catalyst push its whole rounding
    # expression (inlined several times) down into the scan stage.
    base = not_null(positive_total(enriched), "tip_amount")
    return base.groupBy(
        "pu_location_id", "pickup_borough", "pickup_zone", "payment_type",
        fx.distance_bucket("trip_distance").alias("distance_bucket"),
    ).agg(
        F.count(F.lit(1)).alias("trip_count"),
        fx.round2(fx.exact_avg("trip_distance")).alias("avg_trip_distance"),
        fx.round2(fx.exact_avg("tip_percentage")).alias("avg_tip_percentage"),
        fx.round2(fx.exact_avg("tip_amount")).alias("avg_tip_amount"),
        fx.round2(fx.exact_avg("total_amount")).alias("avg_total_amount"),
    )
