"""Incremental form of the historical daily job with Structured Streaming.

New trip files in a folder are picked up by a file stream; every micro-batch
is reduced to exact partial aggregates per (day, pickup zone) and written to
its own ``batch_id=`` partition. Rewriting a partition is idempotent, so a
batch replayed after a failure (the checkpoint records progress) replaces its
own output instead of adding to it. The daily table is the merge of all
partials: sums of counts and of the parts of exact sums, averages last.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from farebox import functions as fx
from farebox.plans import daily

_SUMMED = ["fare_amount", "tip_amount", "trip_distance"]


def partial_daily(cleaned: DataFrame) -> DataFrame:
    """Mergeable partial state per day and pickup zone."""
    secs = F.col("trip_duration_seconds")
    aggs = [F.count(F.lit(1)).alias("trip_count")]
    for c in ["total_amount", *_SUMMED]:
        aggs += [part.alias(f"sum_{c}_{name}") for name, part in fx.sum_parts(c).items()]
        aggs.append(F.count(c).alias(f"n_{c}"))
    aggs += [F.sum(secs).alias("sum_seconds"), F.count(secs).alias("n_seconds")]
    return cleaned.groupBy(*daily.DAILY_KEYS).agg(*aggs)


def merge_partials(partials: DataFrame) -> DataFrame:
    """Final daily x zone aggregate, identical to ``daily.daily_zone``."""
    summed = [c for c in partials.columns if c.startswith(("sum_", "n_"))] + ["trip_count"]
    m = partials.groupBy(*daily.DAILY_KEYS).agg(*[F.sum(c).alias(c) for c in summed])

    def total(c: str):
        return fx.from_parts({name: f"sum_{c}_{name}" for name in fx.PARTS})

    def avg(c: str):
        n = F.col(f"n_{c}")
        return F.when(n > 0, total(c) / n.cast("double")).alias(f"avg_{c}")

    return m.select(
        *daily.DAILY_KEYS, "trip_count",
        total("total_amount").alias("total_revenue"),
        *map(avg, _SUMMED),
        F.when(F.col("n_seconds") > 0,
               (F.col("sum_seconds").cast("double") / 60) / F.col("n_seconds").cast("double")
               ).alias("avg_trip_duration_minutes"),
    )


def write_partials(cleaned_batch: DataFrame, batch_id: int, partials_dir: str) -> None:
    """Write one micro-batch's partials into its own ``batch_id=`` partition.

    Dynamic overwrite makes this idempotent: a batch replayed after a failure
    replaces its earlier output instead of adding to it.
    """
    (partial_daily(cleaned_batch).withColumn("batch_id", F.lit(batch_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(partials_dir))


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.format("binaryFile").load(path).select("path").isEmpty()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def start(spark: SparkSession, input_dir: str, schema: T.StructType, partials_dir: str,
          checkpoint_location: str, files_per_batch: int | None = None,
          available_now: bool = True, path_glob: str = "*.parquet") -> StreamingQuery:
    """Start the stream over trip files (file layout) in ``input_dir``.

    Batches are numbered by the checkpoint, so a new checkpoint over old partials
    would replace some of them and count the other files twice: that is an error."""
    if _exists(spark, partials_dir) and not _exists(spark, f"{checkpoint_location}/offsets"):
        raise ValueError(f"{partials_dir} holds partials of another checkpoint than "
                         f"{checkpoint_location}")
    reader = spark.readStream.schema(schema).option("pathGlobFilter", path_glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.parquet(input_dir)
    cleaned = daily.clean_trips(daily.scan_trips_pruned(files))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_partials(batch, batch_id, partials_dir)

    writer = (cleaned.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_daily(spark: SparkSession, partials_dir: str) -> DataFrame:
    return merge_partials(spark.read.parquet(partials_dir).drop("batch_id"))
