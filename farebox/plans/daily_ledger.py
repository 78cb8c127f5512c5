"""The daily job over a growing set of trip files: only touched months are redone.

A ledger holds, for every processed file as it then was (length and time of its
last change), the months that its usable trips fall in. A run reads new and changed
files once to learn their months, adds the months of changed and vanished files, and
rebuilds these months from all files that touch them. The ledger is written after
the output, so a run that fails in between is repeated by the next one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.plans import daily
from farebox.session import scratch_path
from farebox.sources.sinks import write_partitioned

LEDGER = "seq bigint, file string, length bigint, modified timestamp, months array<int>, here boolean"
_FILE = "__file"


def _plain(path: Column) -> Column:
    """A path with one slash after its scheme: Spark writes it both ways."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def _month() -> Column:
    return F.col("pickup_year") * 100 + F.col("pickup_month")


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, key, length, modified) of the trip files, without opening them. The key
    is the file's name in the hidden path column, where special characters are
    written as codes."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.format("binaryFile").load(paths).select(
        _plain(F.col("path")).alias("file"), _plain(F.col("_metadata.file_path")).alias("key"),
        "length", F.col("modificationTime").alias("modified"))


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The newest entry of every file that was there at the last run."""
    try:
        rows = spark.read.schema(LEDGER).parquet(ledger_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], LEDGER)
    newest = rows.groupBy("file").agg(F.max_by(F.struct("*"), "seq").alias("r")).select("r.*")
    return newest.where("here")


def update_daily(spark: SparkSession, input_path: str | list[str], output_path: str,
                 ledger_path: str) -> list[int]:
    """Bring the partitioned daily table up to date; the months (year * 100 + month)
    that were rebuilt, none if no file changed.

    The result equals a full run over the files, with this in common: a month that
    no usable trip falls in any more keeps its old partition. File names reach the
    driver only as the paths that the readers are given."""
    listed = list_files(spark, input_path)
    known = read_ledger(spark, ledger_path)
    same = ["file", "length", "modified"]
    fresh = [r["file"] for r in listed.join(known, same, "left_anti").select("file").collect()]
    gone = known.join(listed, same, "left_anti")
    seq = (known.agg(F.max("seq")).first()[0] or 0) + 1

    entries = spark.createDataFrame([], "key string, months array<int>")
    if fresh:
        found = daily.clean_trips(daily.read_trip_files(spark, fresh, lineage=_FILE))
        entries = found.groupBy(_plain(F.col(_FILE)).alias("key")).agg(
            F.array_sort(F.collect_set(_month())).alias("months"))
    written = scratch_path(spark, "daily-ledger")
    (listed.join(spark.createDataFrame([(f,) for f in fresh], "file string"), "file", "left_semi")
     .join(entries, "key", "full")
     .select(F.lit(seq).cast("bigint").alias("seq"), "file", "length", "modified",
             F.coalesce("months", F.array().cast("array<int>")).alias("months"),
             F.lit(True).alias("here"))
     .unionByName(gone.where(~F.col("file").isin(fresh)).select(
         F.lit(seq).cast("bigint").alias("seq"), "file", "length", "modified", "months",
         F.lit(False).alias("here")))
     .write.parquet(written))
    change = spark.read.schema(LEDGER).parquet(written)
    if change.where("length IS NULL").limit(1).count():
        raise ValueError("rows of a trip file that is not in the listing")

    months = sorted(r["m"] for r in change.select("months").unionByName(gone.select("months"))
                    .select(F.explode("months").alias("m")).distinct().collect())
    if months:
        touched = F.array(*map(F.lit, months))
        old = known.join(listed, same, "left_semi").where(F.arrays_overlap("months", touched))
        files = sorted({r["file"] for r in old.select("file").collect()} | set(
            r["file"] for r in change.where("here").where(
                F.arrays_overlap("months", touched)).select("file").collect()))
        if files:
            trips = daily.clean_trips(daily.read_trip_files(spark, files))
            write_partitioned(daily.daily_zone(trips.where(_month().isin(months))), output_path,
                              daily.PARTITION_KEYS, dynamic=True)
    if fresh or gone.limit(1).count():
        change.coalesce(1).write.mode("append").parquet(ledger_path)
    return months
