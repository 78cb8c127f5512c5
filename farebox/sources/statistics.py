"""Row counts and load times of tables from the statistics in their files.

The Parquet scan answers COUNT and MAX of whole numbers from footers when the
aggregate is pushed into it, so no column is read. Load times are timestamps, which
are not pushed; tables therefore carry them a second time, as microseconds.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.operators import quality
from farebox.sources.trip_files import epoch_micros_to_ts, ts_to_epoch_micros

LOADED_MICROS = "loaded_at_micros"
FUTURE = "future"
_PUSHED = {"spark.sql.parquet.aggregatePushdown": "true",
           # the aggregate reaches scans of the second source interface only
           "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text"}


def with_load_micros(df: DataFrame) -> DataFrame:
    return df.withColumn(LOADED_MICROS, ts_to_epoch_micros("loaded_at"))


def load_statistics(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """(source, row_count, max_loaded_at) of tables (name -> path) written
    ``with_load_micros``, from their files' footers. The result belongs to a session
    of its own, so the caller's scans stay as they are."""
    own = spark.newSession()
    for key, value in _PUSHED.items():
        own.conf.set(key, value)
    parts = [own.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"),
                                        F.max(LOADED_MICROS).alias("newest"))
             # the pushed count of files without row groups is null; a sum may be
             .groupBy("newest").agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"))
             .select(F.lit(name).alias("source"), "row_count",
                     epoch_micros_to_ts("newest").alias("max_loaded_at"))
             for name, path in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def source_status(statistics: DataFrame, as_of: dt.datetime | str,
                  warn_after: dt.timedelta = quality.FRESH_WARN_AFTER,
                  error_after: dt.timedelta = quality.FRESH_ERROR_AFTER) -> DataFrame:
    """The statistics with the age of the newest load at ``as_of`` in seconds and a
    status: ``future`` if it is later than that, ``error`` or ``warn`` by age, and
    ``error`` for a source without rows."""
    at = F.lit(str(as_of)).cast("timestamp_ntz")
    age = F.floor((ts_to_epoch_micros(at) - ts_to_epoch_micros("max_loaded_at")) / 1_000_000)
    seconds = F.col("age_seconds")
    return statistics.select("*", at.alias("as_of"), age.alias("age_seconds")).withColumn(
        "status", F.when(seconds.isNull(), quality.ERROR).when(seconds < 0, FUTURE)
        .when(seconds > int(error_after.total_seconds()), quality.ERROR)
        .when(seconds > int(warn_after.total_seconds()), quality.WARN).otherwise(quality.PASS))
