"""Staging and intermediate models: row-level, no aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox import functions as fx
from farebox.operators.joins import hot_keys, lookup_join
from farebox.schemas import ENRICH_ZONE_COLUMNS, STG_TRIP_COLUMNS, STG_ZONE_COLUMNS

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"


def stg_trips(raw_trips: DataFrame) -> DataFrame:
    """Explicit 21-column projection; no filter, no cast."""
    return raw_trips.select(*STG_TRIP_COLUMNS)


def stg_zones(raw_zones: DataFrame) -> DataFrame:
    return raw_zones.select(*STG_ZONE_COLUMNS)


def trip_metrics(trips: DataFrame) -> DataFrame:
    """All staging columns plus the eight derived per-trip measures.

    Built in three projections: minute boundaries, then the unrounded ratio
    and speed, then rounding. Catalyst keeps the layers apart rather than
    inlining an expensive expression into every place the rounding uses it,
    so each value is computed once per row and the generated code stays small.
    """
    cols = trips.columns
    minutes = F.col("trip_duration_minutes")
    # Hours keep six decimals (fixed-point division of minutes by 60.0).
    hours = fx.round2(minutes.cast("double") / 60.0, places=6)
    with_minutes = trips.select("*", fx.minute_boundaries(PICKUP, DROPOFF).alias("trip_duration_minutes"))
    with_raw = with_minutes.select(
        "*",
        F.when(F.col("total_amount") > 0,
               (F.col("tip_amount") / F.col("total_amount")) * 100).alias("_tip_raw"),
        F.when(minutes > 0, F.col("trip_distance") / hours).alias("_speed_raw"),
    )
    return with_raw.select(
        *cols,
        fx.pickup_date(PICKUP).alias("pickup_date"),
        fx.month_start(PICKUP).alias("pickup_month"),
        fx.hour_part(PICKUP).alias("pickup_hour"),
        fx.day_name(PICKUP).alias("pickup_day_name"),
        "trip_duration_minutes",
        fx.round2("_tip_raw").alias("tip_percentage"),
        fx.round2("_speed_raw").alias("average_speed_mph"),
        fx.is_weekend(PICKUP).alias("is_weekend"),
    )


def trip_enriched(metrics: DataFrame, zones: DataFrame, salted: bool = False) -> DataFrame:
    """Metrics plus pickup and drop-off zone attributes (two LEFT lookups of
    the same dimension in two roles).

    ``salted`` is for zones too large to broadcast: it counts the trips of each id
    and spreads hot ids and trips without one over the tasks of the joins."""
    out = metrics
    for key, role in (("pu_location_id", "pickup"), ("do_location_id", "dropoff")):
        out = lookup_join(out, zones, key, "location_id",
                          {c: f"{role}_{c}" for c in ENRICH_ZONE_COLUMNS},
                          hot=hot_keys(metrics, key) if salted else None)
    return out
