"""Zone lookup CSV."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.schemas import ZONE_CSV_SCHEMA
from farebox.sources.trip_files import stamp_loaded_at


def read_zones_csv(spark: SparkSession, path: str, failfast: bool = True) -> DataFrame:
    """One header line skipped, fields optionally enclosed in double quotes,
    columns mapped by position (header names are ignored). ``failfast``
    aborts the read on the first malformed record, whatever columns are used
    later: the parser checks only columns that are asked for, so every row's hash,
    which asks for all, must hold a condition that always does."""
    rows = (
        spark.read.schema(ZONE_CSV_SCHEMA)
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST" if failfast else "PERMISSIVE")
        .csv(path)
    )
    if failfast:
        rows = rows.where(F.xxhash64(*rows.columns) >= F.lit(-(2 ** 63)))
    return rows


def load_zones(spark: SparkSession, path: str, as_of: dt.datetime | str | None = None,
               failfast: bool = True) -> DataFrame:
    return stamp_loaded_at(read_zones_csv(spark, path, failfast), as_of)


def write_zones_csv(zones: DataFrame, path: str) -> None:
    """Write the four lookup columns as CSV with a header line."""
    (zones.select("location_id", "borough", "zone", "service_zone")
     .write.mode("overwrite").option("header", True).option("quote", '"')
     .option("escape", '"').csv(path))
