"""The three analyst reports, each reading one mart.

Marts hold at most (zones x months) rows, so the global windows and the final
sort below run on small inputs; none of them touches trip rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox import functions as fx
from farebox.operators.filters import either_rank_at_most, min_support, rank_at_most
from farebox.operators.windows import rank_asc, rank_desc
from farebox.sources.sinks import checkpointed

# Report cut-offs.
TOP_ZONES = 20
TIP_MIN_TRIPS = 100
TIP_TOP = 20


def annual_zone_revenue(mart_zone_revenue: DataFrame) -> DataFrame:
    """Per (location, borough, zone): sum of the monthly rounded revenues and
    of the monthly trip counts, and a global rank by that revenue."""
    annual = mart_zone_revenue.groupBy("pu_location_id", "pickup_borough", "pickup_zone").agg(
        fx.exact_sum("total_revenue").alias("annual_revenue"),
        F.sum("trip_count").alias("annual_trip_count"),
    )
    return annual.withColumn("annual_revenue_rank", rank_desc("annual_revenue"))


def zone_revenue_report(mart_zone_revenue: DataFrame, top: int = TOP_ZONES,
                        materialize_mart: bool = False) -> DataFrame:
    """Monthly rows of the annual top-``top`` pickup zones, with both ranks.

    The annual ranking is joined back on the location id only; the filter on
    the right side's rank makes the LEFT join an inner one, so a NULL location
    (which takes a rank slot) never shows, and an id with several
    (borough, zone) rows fans out.

    The mart is read twice (annual ranking, monthly rows). Unless it is a stored
    table, ``materialize_mart`` is worth its job while planning: the mart, which is
    small (months x zones), is checkpointed first. Else both branches compute the
    whole trip plan, since their column pruning differs and Spark cannot reuse the
    exchanges.
    """
    if materialize_mart:
        mart_zone_revenue = checkpointed(mart_zone_revenue)
    ranked = rank_at_most(annual_zone_revenue(mart_zone_revenue), "annual_revenue_rank", top)
    annual = ranked.select(
        F.col("pu_location_id").alias("_a_loc"), "annual_revenue", "annual_trip_count",
        "annual_revenue_rank")
    monthly = mart_zone_revenue.select(
        "pickup_month", "pu_location_id", "pickup_borough", "pickup_zone", "trip_count",
        "total_revenue", "monthly_revenue_rank")
    # ``annual`` is small (top ranks of a zone-sized table); no hint is given:
    # AQE measures it after its shuffle and broadcasts it when it is small.
    joined = monthly.join(annual, monthly.pu_location_id == annual._a_loc, "left")
    out = rank_at_most(joined, "annual_revenue_rank", top).drop("_a_loc")
    return out.orderBy(F.asc_nulls_last("annual_revenue_rank"), F.asc_nulls_last("pickup_month"))


def hourly_summary(mart_demand_timing: DataFrame) -> DataFrame:
    """Per hour: summed trips, and the unweighted average of the per-day
    rounded averages, rounded again."""
    return mart_demand_timing.groupBy("pickup_hour").agg(
        F.sum("trip_count").alias("total_trips"),
        fx.round2(fx.exact_avg("avg_fare_amount")).alias("avg_fare_amount"),
        fx.round2(fx.exact_avg("avg_total_amount")).alias("avg_total_amount"),
    )


def demand_timing_report(mart_demand_timing: DataFrame) -> DataFrame:
    """One row per pickup hour (a NULL-pickup group included) with peak and
    trough ranks and a period label."""
    ranked = hourly_summary(mart_demand_timing).select(
        "*",
        rank_desc("total_trips").alias("demand_peak_rank"),
        rank_asc("total_trips").alias("demand_trough_rank"),
    )
    out = ranked.withColumn(
        "demand_period_classification",
        fx.period_label("demand_peak_rank", "demand_trough_rank"))
    return out.orderBy(F.asc_nulls_last("pickup_hour"))


def zone_tip_summary(mart_tip_behaviour: DataFrame) -> DataFrame:
    """Per (borough, zone name, payment type, bucket): ids sharing a name, and
    all unmatched ids, merge into one group."""
    return mart_tip_behaviour.groupBy(
        "pickup_borough", "pickup_zone", "payment_type", "distance_bucket").agg(
        F.sum("trip_count").alias("trip_count"),
        fx.round2(fx.exact_avg("avg_trip_distance")).alias("avg_trip_distance"),
        fx.round2(fx.exact_avg("avg_tip_percentage")).alias("avg_tip_percentage"),
        fx.round2(fx.exact_avg("avg_tip_amount")).alias("avg_tip_amount"),
        fx.round2(fx.exact_avg("avg_total_amount")).alias("avg_total_amount"),
    )


def tip_behaviour_report(mart_tip_behaviour: DataFrame, min_trips: int = TIP_MIN_TRIPS,
                         top: int = TIP_TOP) -> DataFrame:
    """Highest and lowest tipping groups among those with enough trips."""
    supported = min_support(zone_tip_summary(mart_tip_behaviour), "trip_count", min_trips)
    ranked = supported.select(
        "*",
        rank_desc("avg_tip_percentage").alias("highest_tip_rank"),
        rank_asc("avg_tip_percentage").alias("lowest_tip_rank"),
    )
    out = either_rank_at_most(ranked, "highest_tip_rank", "lowest_tip_rank", top)
    return out.orderBy(F.desc_nulls_first("avg_tip_percentage"))
