"""Declared schemas and column lists per layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw trip table, (table column, type, name in the trip file),
# in the order of the load DDL. ``source_file`` and ``loaded_at`` are filled
# by the loader, not read from the file.
TRIP_FIELDS = [
    ("vendor_id", T.IntegerType(), "VendorID"),
    ("tpep_pickup_datetime", T.TimestampNTZType(), "tpep_pickup_datetime"),
    ("tpep_dropoff_datetime", T.TimestampNTZType(), "tpep_dropoff_datetime"),
    ("passenger_count", T.IntegerType(), "passenger_count"),
    ("trip_distance", T.DoubleType(), "trip_distance"),
    ("ratecode_id", T.IntegerType(), "RatecodeID"),
    ("store_and_fwd_flag", T.StringType(), "store_and_fwd_flag"),
    ("pu_location_id", T.IntegerType(), "PULocationID"),
    ("do_location_id", T.IntegerType(), "DOLocationID"),
    ("payment_type", T.IntegerType(), "payment_type"),
    ("fare_amount", T.DoubleType(), "fare_amount"),
    ("extra", T.DoubleType(), "extra"),
    ("mta_tax", T.DoubleType(), "mta_tax"),
    ("tip_amount", T.DoubleType(), "tip_amount"),
    ("tolls_amount", T.DoubleType(), "tolls_amount"),
    ("improvement_surcharge", T.DoubleType(), "improvement_surcharge"),
    ("total_amount", T.DoubleType(), "total_amount"),
    ("congestion_surcharge", T.DoubleType(), "congestion_surcharge"),
    ("airport_fee", T.DoubleType(), "Airport_fee"),
]

# Fields that files of some years lack; every other field is required of a strict load.
OPTIONAL_FIELDS = {"congestion_surcharge", "Airport_fee"}
REQUIRED_FIELDS = [f for _, _, f in TRIP_FIELDS if f not in OPTIONAL_FIELDS]

RAW_TRIPS_SCHEMA = T.StructType(
    [T.StructField(name, dtype, True) for name, dtype, _ in TRIP_FIELDS]
    + [T.StructField("source_file", T.StringType(), True),
       T.StructField("loaded_at", T.TimestampNTZType(), True)]
)

# Zone lookup CSV: positional, one header line.
ZONE_CSV_SCHEMA = T.StructType([
    T.StructField("location_id", T.IntegerType(), True),
    T.StructField("borough", T.StringType(), True),
    T.StructField("zone", T.StringType(), True),
    T.StructField("service_zone", T.StringType(), True),
])

RAW_ZONES_SCHEMA = T.StructType(
    ZONE_CSV_SCHEMA.fields + [T.StructField("loaded_at", T.TimestampNTZType(), True)]
)

STG_TRIP_COLUMNS = [f.name for f in RAW_TRIPS_SCHEMA.fields]
STG_ZONE_COLUMNS = [f.name for f in RAW_ZONES_SCHEMA.fields]

# Columns derived by the trip-metrics model, in model order.
METRIC_COLUMNS = [
    "pickup_date", "pickup_month", "pickup_hour", "pickup_day_name",
    "trip_duration_minutes", "tip_percentage", "average_speed_mph", "is_weekend",
]

# Zone columns added by the enrichment model, (zone column, role prefix).
ENRICH_ZONE_COLUMNS = ["borough", "zone", "service_zone"]

# The ten columns the historical job reads, with its two renames.
DAILY_JOB_COLUMNS = [
    ("tpep_pickup_datetime", "tpep_pickup_datetime"),
    ("tpep_dropoff_datetime", "tpep_dropoff_datetime"),
    ("PULocationID", "pickup_location_id"),
    ("DOLocationID", "dropoff_location_id"),
    ("passenger_count", "passenger_count"),
    ("trip_distance", "trip_distance"),
    ("fare_amount", "fare_amount"),
    ("tip_amount", "tip_amount"),
    ("total_amount", "total_amount"),
    ("payment_type", "payment_type"),
]
