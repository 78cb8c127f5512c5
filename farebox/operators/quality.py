"""Data-quality checks as DataFrames.

Each check returns violations or status rows instead of raising, so it runs
as an ordinary distributed job and its result can be inspected, stored or
compared. ``raise_on_errors`` turns collected status rows (one per test) into a
gate.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.functions.util import as_col

# The tests the staging models declare.
TRIP_NOT_NULL = ["vendor_id", "tpep_pickup_datetime", "tpep_dropoff_datetime",
                 "pu_location_id", "do_location_id"]
ZONE_NOT_NULL = ["location_id"]
ZONE_UNIQUE = ["location_id"]
TRIP_DURATION = ("tpep_pickup_datetime", "tpep_dropoff_datetime")

# Freshness thresholds of both raw sources.
FRESH_WARN_AFTER = dt.timedelta(days=1)
FRESH_ERROR_AFTER = dt.timedelta(days=2)

PASS, WARN, ERROR = "pass", "warn", "error"


class DataQualityError(RuntimeError):
    pass


class FileValidationError(RuntimeError):
    """``problems`` holds what was found, as dicts."""

    def __init__(self, problems: list[dict]):
        self.problems = problems
        super().__init__("; ".join(f"{p['problem']} {p['subject']}: wanted {p['wanted']}, "
                                   f"found {p['found']}" for p in problems))


def not_null_failures(df: DataFrame, columns: list[str], model: str = "") -> DataFrame:
    """(model, column_name, failures): NULL count per column, one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    out = counts.unpivot([], columns, "column_name", "failures")
    return out.select(F.lit(model).alias("model"), "column_name", "failures")


def unique_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key values (all parts non-NULL) that occur more than once, with their
    record count. A hot key is pre-aggregated map-side like any count."""
    keyed = df.select(*columns)
    for c in columns:
        keyed = keyed.filter(F.col(c).isNotNull())
    return (keyed.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def reversed_trip_times(df: DataFrame, pickup_col: str = TRIP_DURATION[0],
                        dropoff_col: str = TRIP_DURATION[1]) -> DataFrame:
    """Rows whose drop-off is before the pickup (they are reported, and kept
    in every downstream model)."""
    return df.filter(F.col(dropoff_col) < F.col(pickup_col))


def status_of(failures, severity) -> Column:
    """pass when there are no failures, else the test's severity."""
    f, s = as_col(failures), as_col(severity)
    return F.when(f == 0, PASS).when(s == WARN, WARN).otherwise(ERROR)


def quality_summary(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """All declared tests with (test_name, model, column_name, severity,
    failures, status). The trip tests share a single scan; the reversed-time
    test has warn severity, every other test error severity."""
    trip_counts = trips.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"nn_{c}") for c in TRIP_NOT_NULL],
        F.count_if(F.col(TRIP_DURATION[1]) < F.col(TRIP_DURATION[0])).alias("vd"),
    )
    stack_args = []
    for c in TRIP_NOT_NULL:
        stack_args += [F.lit("not_null"), F.lit(c), F.lit(ERROR), F.col(f"nn_{c}")]
    stack_args += [F.lit("valid_trip_duration"), F.lit(None).cast("string"), F.lit(WARN), F.col("vd")]
    trip_rows = trip_counts.select(
        F.lit("stg_yellow_taxi_trips").alias("model"),
        F.inline(F.array(*[
            F.struct(stack_args[i].alias("test_name"), stack_args[i + 1].alias("column_name"),
                     stack_args[i + 2].alias("severity"), stack_args[i + 3].alias("failures"))
            for i in range(0, len(stack_args), 4)])),
    )
    zone_nn = zones.agg(F.count_if(F.col(ZONE_NOT_NULL[0]).isNull()).alias("failures")).select(
        F.lit("stg_taxi_zone_lookup").alias("model"), F.lit("not_null").alias("test_name"),
        F.lit(ZONE_NOT_NULL[0]).alias("column_name"), F.lit(ERROR).alias("severity"), "failures")
    zone_uq = unique_violations(zones, ZONE_UNIQUE).agg(
        F.count(F.lit(1)).alias("failures")).select(
        F.lit("stg_taxi_zone_lookup").alias("model"), F.lit("unique").alias("test_name"),
        F.lit(ZONE_UNIQUE[0]).alias("column_name"), F.lit(ERROR).alias("severity"), "failures")
    cols = ["test_name", "model", "column_name", "severity", "failures"]
    allrows = reduce(DataFrame.unionByName, [trip_rows.select(*cols), zone_nn.select(*cols),
                                             zone_uq.select(*cols)])
    return allrows.withColumn("status", status_of("failures", "severity"))


def freshness(df: DataFrame, ts_col: str, as_of: dt.datetime | str, source: str,
              warn_after: dt.timedelta = FRESH_WARN_AFTER,
              error_after: dt.timedelta = FRESH_ERROR_AFTER) -> DataFrame:
    """One row: the newest load time, its age at ``as_of`` in seconds and a
    status (error beyond ``error_after``, warn beyond ``warn_after``; an empty
    source is an error)."""
    as_of_col = F.lit(str(as_of)).cast("timestamp_ntz")
    newest = df.agg(F.max(ts_col).alias("max_loaded_at"))
    age = F.unix_timestamp(as_of_col) - F.unix_timestamp(F.col("max_loaded_at"))
    return newest.select(
        F.lit(source).alias("source"), "max_loaded_at", as_of_col.alias("as_of"),
        age.alias("age_seconds"),
    ).withColumn(
        "status",
        F.when(F.col("age_seconds").isNull(), ERROR)
        .when(F.col("age_seconds") > int(error_after.total_seconds()), ERROR)
        .when(F.col("age_seconds") > int(warn_after.total_seconds()), WARN)
        .otherwise(PASS),
    )


def raise_on_errors(rows: list, status_col: str = "status") -> None:
    """Raise if any of the status rows (one per test) has error status."""
    errors = [r for r in rows if r[status_col] == ERROR]
    if errors:
        raise DataQualityError("; ".join(str(r.asDict()) for r in errors))


# --- input file manifest --------------------------------------------------

def list_files(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """(file_name, size_bytes) for the files in ``directory`` matching the
    glob ``pattern``.

    Sizes come from the ``binaryFile`` source with its ``content`` column
    pruned (no file is read). File sources produce no row for a zero-byte
    file, so the names come from the source's file index (``inputFiles``,
    metadata the driver lists anyway) and missing sizes mean empty files.
    """
    try:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
                 .load(directory))
        names = files.inputFiles()
    except AnalysisException:
        return spark.createDataFrame([], "file_name string, size_bytes bigint")

    def base(c):
        return F.element_at(F.split(c, "/"), -1)

    indexed = spark.createDataFrame([(p,) for p in names], "path string").select(
        base("path").alias("file_name"))
    sized = files.select(base("path").alias("file_name"), F.col("length").alias("size_bytes"))
    return indexed.join(sized, "file_name", "left").select(
        "file_name", F.coalesce("size_bytes", F.lit(0)).cast("bigint").alias("size_bytes"))


def file_exists(spark: SparkSession, path: str) -> bool:
    try:
        return len(spark.read.format("binaryFile").load(path).inputFiles()) > 0
    except AnalysisException:
        return False


def file_manifest(spark: SparkSession, directory: str, pattern: str, lookup_path: str,
                  expected_count: int) -> DataFrame:
    """One summary row: file count, lookup present, total MB (2 places), the
    sorted file names, empty files, and every problem found (problem, subject,
    wanted, found), as all checks run before anything fails."""
    files = list_files(spark, directory, pattern)
    lookup_ok = file_exists(spark, lookup_path)
    summary = files.agg(
        F.count(F.lit(1)).alias("parquet_file_count"),
        F.round(F.coalesce(F.sum("size_bytes"), F.lit(0)) / (1024 * 1024), 2).alias("total_parquet_size_mb"),
        F.sort_array(F.collect_list("file_name")).alias("files"),
        F.sort_array(F.collect_list(F.when(F.col("size_bytes") == 0, F.col("file_name")))).alias("empty_files"),
    )
    def problem(kind: str, subject, wanted, found) -> Column:
        return F.struct(F.lit(kind).alias("problem"), as_col(subject).alias("subject"),
                        as_col(wanted).cast("string").alias("wanted"),
                        as_col(found).cast("string").alias("found"))

    count = F.when(F.col("parquet_file_count") != expected_count, problem(
        "file count", F.lit(pattern), F.lit(expected_count), "parquet_file_count"))
    lookup = F.when(F.lit(not lookup_ok), problem("lookup", F.lit(lookup_path), F.lit(1), F.lit(0)))
    empty = F.transform("empty_files", lambda f: problem("file size", f, F.lit("> 0"), F.lit(0)))
    errors = F.concat(F.array_compact(F.array(count, lookup)), empty)
    return summary.select(
        "parquet_file_count", F.lit(lookup_ok).alias("lookup_file_exists"),
        "total_parquet_size_mb", "files", "empty_files", errors.alias("errors"))


def validate_files(spark: SparkSession, directory: str, pattern: str, lookup_path: str,
                   expected_count: int) -> dict:
    """Raise ``FileValidationError`` listing all problems, else return the
    summary as a dict."""
    row = file_manifest(spark, directory, pattern, lookup_path, expected_count).first()
    if row["errors"]:
        raise FileValidationError([e.asDict() for e in row["errors"]])
    return row.asDict()
