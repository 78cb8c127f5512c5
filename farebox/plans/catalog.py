"""Named queries over the driver's tables, one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame built from
the star-schema tables through the trip mapping in ``farebox.fixtures``.
Entries exercising sinks or loaders first write Spark-derived data under the
session's checkpoint folder and read it back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox import functions as fx
from farebox.fixtures import read_table, star_trips, star_zones, to_file_layout
from farebox.operators import filters, quality
from farebox.operators.joins import lookup_join
from farebox.operators.windows import rank_asc, rank_desc
from farebox.plans import daily, daily_ledger, marts, models, pipeline, reports
from farebox.session import scratch_path, session_key
from farebox.sources import footers, releases, semistructured, sinks, statistics, trip_files, zone_csv
from farebox.streaming import daily_incremental

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values used by the catalogue: load instants and the freshness as-of.
LOAD_AS_OF = "2024-01-01 00:00:00"
FRESHNESS_AS_OF = "1998-08-04 12:00:00"
PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"


# --- shared layers ---------------------------------------------------------

# Lazy layer plans are defined once per session and data folder, as the
# staging views of a warehouse are: only the plan object is reused (no data is
# cached), and the zone-size check behind the broadcast runs once.
_LAYERS: dict[tuple, DataFrame] = {}


def _layer(spark: SparkSession, d: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    own = session_key(spark)
    for other in [k for k in _LAYERS if k[:len(own)] != own]:
        del _LAYERS[other]                   # plans of sessions that came before
    key = (*own, d.rstrip("/"), name)
    df = _LAYERS.get(key)
    if df is None:
        df = _LAYERS[key] = build()
    return df


def _trips(spark, d):
    return _layer(spark, d, "stg_trips", lambda: models.stg_trips(star_trips(spark, d)))


def _zones(spark, d):
    return _layer(spark, d, "stg_zones", lambda: models.stg_zones(star_zones(spark, d)))


def _metrics(spark, d):
    return _layer(spark, d, "metrics", lambda: models.trip_metrics(_trips(spark, d)))


def _enriched(spark, d):
    return _layer(spark, d, "enriched",
                  lambda: models.trip_enriched(_metrics(spark, d), _zones(spark, d)))


def _mart_zone_revenue(spark, d):
    return _layer(spark, d, "mart_zone_revenue", lambda: marts.zone_revenue(_enriched(spark, d)))


def _mart_demand(spark, d):
    return _layer(spark, d, "mart_demand_timing", lambda: marts.demand_timing(_enriched(spark, d)))


def _mart_tip(spark, d):
    return _layer(spark, d, "mart_tip_behaviour", lambda: marts.tip_behaviour(_enriched(spark, d)))


def _file_layout(spark, d):
    return _layer(spark, d, "file_layout", lambda: to_file_layout(star_trips(spark, d)))


def _written_files(spark, d, name):
    """Trip files written by Spark from the mapping, one or more a task."""
    path = scratch_path(spark, name)
    _file_layout(spark, d).write.mode("overwrite").parquet(path)
    return path


def _daily(spark, d):
    return _layer(spark, d, "daily", lambda: daily.daily_zone_from_files(_file_layout(spark, d)))


# --- sources and sinks -----------------------------------------------------

def load_trips_typed(spark, d):
    path = _written_files(spark, d, "trip-files")
    loaded = trip_files.load_trips(spark, f"{path}/part-*.parquet", as_of=LOAD_AS_OF)
    return loaded.drop("source_file")


def _written_mixed_files(spark, d, name):
    """Trip files in three layouts by pickup zone: without the airport fee, with
    narrow ids and whole passenger counts, and as ``to_file_layout`` has them."""
    path = scratch_path(spark, name)
    trips = _file_layout(spark, d)
    layout = F.coalesce(F.col("PULocationID") % 3, F.lit(2))
    trips.where(layout == 0).drop("Airport_fee").write.parquet(f"{path}/a")
    narrow = {c: F.col(c).cast("int") for c in ("VendorID", "PULocationID", "DOLocationID")}
    (trips.where(layout == 1).withColumns(narrow)
     .withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
     .write.parquet(f"{path}/b"))
    trips.where(layout == 2).write.parquet(f"{path}/c")
    return path


def load_trips_mixed(spark, d):
    path = _written_mixed_files(spark, d, "trip-files-mixed")
    loaded = trip_files.load_trips(spark, f"{path}/*/part-*.parquet", as_of=LOAD_AS_OF)
    return loaded.drop("source_file")


def job_daily_mixed(spark, d):
    src = _written_mixed_files(spark, d, "job-input-mixed")
    out = scratch_path(spark, "job-output-mixed")
    daily.run_daily_job(spark, f"{src}/*/part-*.parquet", out)
    return spark.read.parquet(out)


def load_zones_csv(spark, d):
    path = scratch_path(spark, "zone-csv")
    zone_csv.write_zones_csv(_zones(spark, d), path)
    return zone_csv.load_zones(spark, path, as_of=LOAD_AS_OF)


def load_failfast(spark, d):
    path = scratch_path(spark, "zone-csv-failfast")
    zone_csv.write_zones_csv(_zones(spark, d), path)
    return zone_csv.load_zones(spark, path, as_of=LOAD_AS_OF, failfast=True)


def load_abort(spark, d):
    """Both kinds of file, with and without one record that can't be cast: what is
    loaded of clean files, and whether the others abort when they are counted."""
    trips, zones = _file_layout(spark, d), _zones(spark, d)
    clean, bad = scratch_path(spark, "abort-clean"), scratch_path(spark, "abort-bad")
    trips.write.parquet(f"{clean}/trips")
    trips.write.parquet(f"{bad}/trips/good")
    (trips.limit(1).withColumn("passenger_count", F.lit("two"))
     .write.parquet(f"{bad}/trips/bad"))
    zone_csv.write_zones_csv(zones, f"{clean}/zones")
    texts = zones.withColumn("location_id", F.col("location_id").cast("string"))
    zone_csv.write_zones_csv(texts.union(texts.limit(1).withColumn("location_id", F.lit("x"))),
                             f"{bad}/zones")

    def load_trips(path, *more):
        return trip_files.load_trips(spark, [f"{path}/trips{m}" for m in more], as_of=LOAD_AS_OF)

    rows = []
    for kind, good, broken in (
            ("taxi_zone_lookup", lambda: zone_csv.load_zones(spark, f"{clean}/zones"),
             lambda: zone_csv.load_zones(spark, f"{bad}/zones")),
            ("yellow_taxi_trips", lambda: load_trips(clean, ""),
             lambda: load_trips(bad, "/good", "/bad"))):
        try:
            broken().count()
            aborted = False
        except (PySparkException, Py4JJavaError):
            aborted = True
        rows.append((kind, good().count(), aborted))
    return spark.createDataFrame(rows, "kind string, loaded_rows bigint, bad_file_aborts boolean")


def scan_footers(spark, d):
    """Rows per field and type, from the footers of files in three layouts."""
    path = _written_mixed_files(spark, d, "trip-files-footers")
    found = footers.footers(spark, f"{path}/*/part-*.parquet")
    return found.groupBy("field", "type").agg(F.sum("row_count").alias("row_count"))


def scan_glob(spark, d):
    path = _written_files(spark, d, "trip-files-glob")
    return daily.read_trip_files(spark, f"{path}/part-*.parquet")


def rows_per_source_file(spark, d):
    """Files of a year each, named by their folder: lineage from the hidden path
    column."""
    path = scratch_path(spark, "trip-files-lineage")
    to_file_layout(star_trips(spark, d), keep=["source_file"]).write.partitionBy(
        "source_file").parquet(path)
    name = F.regexp_extract("_metadata.file_path", "source_file=([^/]+)/", 1)
    loaded = trip_files.load_trips(spark, path, as_of=LOAD_AS_OF, source_file=name)
    return loaded.groupBy("source_file").agg(F.count(F.lit(1)).alias("row_count"))


def stamp_loaded_at(spark, d):
    return trip_files.stamp_loaded_at(_trips(spark, d).drop("loaded_at"), LOAD_AS_OF)


def load_full_refresh(spark, d):
    path = scratch_path(spark, "raw-trips")
    for _ in range(2):  # a rerun replaces the table, it does not append
        sinks.write_table(_trips(spark, d), path)
    return spark.read.parquet(path)


def extract_path_cast(spark, d):
    ev = read_table(spark, d, "events")
    return ev.select(
        "event_id",
        semistructured.extract_path("props", "$.k", "int").alias("k"),
        semistructured.extract_path("props", "$.missing", "int").alias("missing"),
    )


def epoch_micros_to_ts(spark, d):
    ev = read_table(spark, d, "events")
    micros = trip_files.ts_to_epoch_micros("ts")
    return ev.select("event_id", micros.alias("ts_micros"),
                     trip_files.epoch_micros_to_ts(micros).alias("ts_roundtrip"))


def scan_trips_pruned(spark, d):
    return daily.scan_trips_pruned(_file_layout(spark, d))


def sink_daily_partitioned(spark, d):
    path = scratch_path(spark, "daily-partitioned")
    sinks.write_partitioned(_daily(spark, d), path, daily.PARTITION_KEYS, dynamic=True)
    return spark.read.parquet(path)


def sink_dynamic_overwrite(spark, d):
    """Write every month, then rewrite the earliest month with only its
    first half; the other months must stay as they were."""
    path = scratch_path(spark, "daily-dynamic")
    stored = scratch_path(spark, "daily-rows")
    _daily(spark, d).write.parquet(stored)       # read three times below
    agg = spark.read.parquet(stored)
    sinks.write_partitioned(agg, path, daily.PARTITION_KEYS, dynamic=True)
    first = agg.agg(F.min(F.struct("pickup_year", "pickup_month")).alias("m")).select("m.*")
    redo = (agg.join(first, ["pickup_year", "pickup_month"], "left_semi")
            .filter(F.dayofmonth("pickup_date") <= 15))
    sinks.write_partitioned(redo, path, daily.PARTITION_KEYS, dynamic=True)
    return spark.read.parquet(path)


def materialize_layers(spark, d):
    view = sinks.materialize(spark, _metrics(spark, d), "view", "int_trip_metrics")
    enriched = models.trip_enriched(view, _zones(spark, d))
    return sinks.materialize(spark, enriched, "table", "int_trip_enriched",
                             scratch_path(spark, "int-trip-enriched"))


def stg_trips(spark, d):
    return _trips(spark, d)


def stg_zones(spark, d):
    return _zones(spark, d)


# --- scalar functions --------------------------------------------------------

def _proj(cols: Callable[[], list]) -> Query:
    """A projection of the staging trips; ``cols`` builds the columns lazily."""
    def q(spark, d):
        return _trips(spark, d).select(*cols())
    return q


fn_pickup_date = _proj(lambda: [PICKUP, fx.pickup_date(PICKUP).alias("pickup_date")])
fn_pickup_month = _proj(lambda: [PICKUP, fx.month_start(PICKUP).alias("pickup_month")])
fn_year_month = _proj(lambda: [PICKUP, fx.year_part(PICKUP).alias("pickup_year"),
                               fx.month_number(PICKUP).alias("pickup_month_number")])
fn_pickup_hour = _proj(lambda: [PICKUP, fx.hour_part(PICKUP).alias("pickup_hour")])
fn_day_name = _proj(lambda: [PICKUP, fx.day_name(PICKUP).alias("pickup_day_name")])
fn_duration_boundary_min = _proj(lambda: [
    PICKUP, DROPOFF, fx.minute_boundaries(PICKUP, DROPOFF).alias("trip_duration_minutes")])
fn_duration_elapsed_min = _proj(lambda: [
    PICKUP, DROPOFF, fx.elapsed_minutes(PICKUP, DROPOFF).alias("elapsed_minutes")])
fn_is_weekend = _proj(lambda: [PICKUP, fx.is_weekend(PICKUP).alias("is_weekend")])
fn_distance_bucket = _proj(lambda: [
    "trip_distance", fx.distance_bucket("trip_distance").alias("distance_bucket")])
fn_round2 = _proj(lambda: [
    "fare_amount", "trip_distance",
    fx.round2(F.col("fare_amount") * 1.005).alias("fare_x_1005_r2"),
    fx.round2(F.col("trip_distance") / 3).alias("distance_third_r2")])
fn_casts = _proj(lambda: [
    fx.pickup_date(PICKUP).alias("pickup_date"),
    fx.to_int("fare_amount").alias("fare_int"),
    F.col("vendor_id").cast("string").alias("vendor_str"),
    F.col("passenger_count").cast("double").alias("passengers_float")])
fn_guarded_ratio = _proj(lambda: [
    "tip_amount", "total_amount",
    fx.guarded_ratio("tip_amount", "total_amount", 100).alias("tip_ratio")])


def fn_tip_percentage(spark, d):
    return _metrics(spark, d).select("tip_amount", "total_amount", "tip_percentage")


def fn_average_speed(spark, d):
    return _metrics(spark, d).select("trip_distance", "trip_duration_minutes", "average_speed_mph")


def fn_period_label(spark, d):
    return reports.demand_timing_report(_mart_demand(spark, d)).select(
        "pickup_hour", "demand_period_classification")


def model_trip_metrics(spark, d):
    return _metrics(spark, d)


# --- filters -------------------------------------------------------------

def filter_positive_total(spark, d):
    return filters.positive_total(_trips(spark, d))


def filter_month_not_null(spark, d):
    return filters.not_null(_metrics(spark, d), "pickup_month").select(
        PICKUP, "pickup_month", "total_amount")


def filter_tip_not_null(spark, d):
    return filters.not_null(_metrics(spark, d), "tip_percentage").select(
        "tip_amount", "total_amount", "tip_percentage")


def filter_clean_trips(spark, d):
    return daily.clean_trips(daily.scan_trips_pruned(_file_layout(spark, d))).drop(
        "trip_duration_seconds")


def topk_zones_by_rank(spark, d):
    ranked = reports.annual_zone_revenue(_mart_zone_revenue(spark, d))
    return filters.rank_at_most(ranked, "annual_revenue_rank", reports.TOP_ZONES)


def topk_either_end(spark, d):
    """Tip groups among the 20 highest or the 20 lowest."""
    return filters.either_rank_at_most(rank_tip_high_low(spark, d), "highest_tip_rank",
                                       "lowest_tip_rank", reports.TIP_TOP)


def filter_min_support(spark, d):
    return filters.min_support(reports.zone_tip_summary(_mart_tip(spark, d)), "trip_count",
                               reports.TIP_MIN_TRIPS)


def dq_valid_trip_duration(spark, d):
    return quality.reversed_trip_times(_trips(spark, d))


# --- joins ---------------------------------------------------------------

def join_pickup_zone(spark, d):
    return lookup_join(_trips(spark, d), _zones(spark, d), "pu_location_id", "location_id",
                       {"borough": "pickup_borough", "zone": "pickup_zone",
                        "service_zone": "pickup_service_zone"})


def join_salted(spark, d):
    """Both lookups with hot and NULL ids spread over the tasks."""
    return models.trip_enriched(_metrics(spark, d), _zones(spark, d), salted=True)


def model_trip_enriched(spark, d):
    return _enriched(spark, d)


def join_self_aggregate(spark, d):
    """A mart joined with its own ranking, by location, before any cut-off."""
    mart = sinks.checkpointed(_mart_zone_revenue(spark, d))
    annual = reports.annual_zone_revenue(mart).select(
        F.col("pu_location_id").alias("_a_loc"), "annual_revenue", "annual_trip_count",
        "annual_revenue_rank")
    return mart.drop("avg_trip_revenue").join(
        annual, F.col("pu_location_id") == F.col("_a_loc"), "left").drop("_a_loc")


# --- aggregations and windows --------------------------------------------

def agg_zone_month(spark, d):
    return _mart_zone_revenue(spark, d).drop("monthly_revenue_rank")


def mart_zone_revenue(spark, d):
    return _mart_zone_revenue(spark, d)


def mart_demand_timing(spark, d):
    return _mart_demand(spark, d)


def mart_tip_behaviour(spark, d):
    return _mart_tip(spark, d)


def agg_daily_zone(spark, d):
    return _daily(spark, d)


def reagg_annual_revenue(spark, d):
    return reports.annual_zone_revenue(_mart_zone_revenue(spark, d)).drop("annual_revenue_rank")


def reagg_avg_of_avg(spark, d):
    return reports.hourly_summary(_mart_demand(spark, d))


def row_counts(spark, d):
    parts = [
        _trips(spark, d).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit("yellow_taxi_trips").alias("table_name"), "row_count"),
        _zones(spark, d).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit("taxi_zone_lookup").alias("table_name"), "row_count"),
    ]
    return reduce(DataFrame.unionByName, parts)


def rank_annual_revenue(spark, d):
    return reports.annual_zone_revenue(_mart_zone_revenue(spark, d))


def rank_peak_trough(spark, d):
    return reports.hourly_summary(_mart_demand(spark, d)).select(
        "*", rank_desc("total_trips").alias("demand_peak_rank"),
        rank_asc("total_trips").alias("demand_trough_rank"))


def rank_tip_high_low(spark, d):
    supported = filter_min_support(spark, d)
    return supported.select(
        "*", rank_desc("avg_tip_percentage").alias("highest_tip_rank"),
        rank_asc("avg_tip_percentage").alias("lowest_tip_rank"))


# --- reports ---------------------------------------------------------------

def report_zone_revenue(spark, d):
    return reports.zone_revenue_report(_mart_zone_revenue(spark, d), materialize_mart=True)


def report_demand_timing(spark, d):
    return reports.demand_timing_report(_mart_demand(spark, d))


def report_tip_behaviour(spark, d):
    return reports.tip_behaviour_report(_mart_tip(spark, d))


def job_daily_zone(spark, d):
    src = _written_files(spark, d, "trip-files-job")
    out = scratch_path(spark, "daily-zone-job")
    daily.run_daily_job(spark, f"{src}/part-*.parquet", out)
    return spark.read.parquet(out)


def _published(spark, d):
    """One run over the mapped trips, which have NULL pickups and locations, so that
    the gate only reports; its base folder."""
    base = scratch_path(spark, "pipeline")
    pipeline.run(spark, star_trips(spark, d), star_zones(spark, d), base, gate=False)
    return base


def pipeline_publish(spark, d):
    """Entry A end to end, the zone-revenue mart of the current release."""
    return releases.read_table(spark, _published(spark, d), "marts", "mart_zone_revenue")


def pipeline_by_name(spark, d):
    """Rows and trips of all released tables, by their names in another session."""
    _published(spark, d)
    other = spark.newSession()
    tables = {"intermediate.int_trip_enriched": F.count(F.lit(1)),
              "staging.stg_yellow_taxi_trips": F.count(F.lit(1)),
              **{f"marts.{m}": F.sum("trip_count") for m in pipeline.MARTS}}
    return reduce(DataFrame.unionByName, [
        other.table(t).agg(F.count(F.lit(1)).alias("row_count"), trips.alias("trips"))
        .select(F.lit(t).alias("table_name"), "row_count", "trips") for t, trips in tables.items()])


def dq_source_status(spark, d):
    """Row counts, newest loads and freshness of the raw tables of a release."""
    base = _published(spark, d)
    release = releases.current(spark, base)
    return statistics.source_status(statistics.load_statistics(spark, {
        name: releases.table_path(base, layer, name, release.run_id)
        for layer, name in (pipeline.RAW_TRIPS, pipeline.RAW_ZONES)}), FRESHNESS_AS_OF)


def job_daily_ledger(spark, d):
    """The daily job over files of a year each, of which the latest comes late."""
    src, out = scratch_path(spark, "ledger-input"), scratch_path(spark, "ledger-output")
    ledger = scratch_path(spark, "ledger")
    years = to_file_layout(star_trips(spark, d), keep=["source_file"])
    last = years.agg(F.max("source_file")).first()[0]
    years.where(F.col("source_file") < last).write.partitionBy("source_file").parquet(src)
    daily_ledger.update_daily(spark, src, out, ledger)
    late = F.coalesce(F.col("source_file"), F.lit(last)) == last
    years.where(late).write.mode("append").partitionBy("source_file").parquet(src)
    daily_ledger.update_daily(spark, src, out, ledger)
    return spark.read.parquet(out)


def stream_daily_zone(spark, d):
    """The daily job run incrementally: one micro-batch per trip file."""
    src = _written_files(spark, d, "trip-files-stream")
    base = scratch_path(spark, "daily-stream")
    schema = spark.read.parquet(src).schema
    q = daily_incremental.start(spark, src, schema, f"{base}/partials", f"{base}/_checkpoint",
                                files_per_batch=1, path_glob="part-*.parquet")
    q.awaitTermination()
    return daily_incremental.read_daily(spark, f"{base}/partials")


# --- data quality ------------------------------------------------------------

def dq_not_null(spark, d):
    return reduce(DataFrame.unionByName, [
        quality.not_null_failures(_trips(spark, d), quality.TRIP_NOT_NULL, "stg_yellow_taxi_trips"),
        quality.not_null_failures(_zones(spark, d), quality.ZONE_NOT_NULL, "stg_taxi_zone_lookup"),
    ])


def dq_unique(spark, d):
    return quality.unique_violations(_zones(spark, d), quality.ZONE_UNIQUE)


def dq_unique_order_line(spark, d):
    return quality.unique_violations(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_summary(spark, d):
    return quality.quality_summary(_trips(spark, d), _zones(spark, d))


def dq_freshness(spark, d):
    return reduce(DataFrame.unionByName, [
        quality.freshness(_trips(spark, d), "loaded_at", FRESHNESS_AS_OF, "yellow_taxi_trips"),
        quality.freshness(_zones(spark, d), "loaded_at", FRESHNESS_AS_OF, "taxi_zone_lookup"),
    ])


def dq_file_manifest(spark, d):
    return quality.file_manifest(spark, d, "*.parquet", f"{d.rstrip('/')}/nation.parquet", 12)


QUERIES: dict[str, Query] = {
    # sources / sinks
    "load_trips_typed": load_trips_typed,
    "load_trips_mixed": load_trips_mixed,
    "job_daily_mixed": job_daily_mixed,
    "load_zones_csv": load_zones_csv,
    "load_abort": load_abort,
    "scan_footers": scan_footers,
    "scan_glob": scan_glob,
    "rows_per_source_file": rows_per_source_file,
    "stamp_loaded_at": stamp_loaded_at,
    "load_failfast": load_failfast,
    "load_full_refresh": load_full_refresh,
    "extract_path_cast": extract_path_cast,
    "epoch_micros_to_ts": epoch_micros_to_ts,
    "scan_trips_pruned": scan_trips_pruned,
    "sink_daily_partitioned": sink_daily_partitioned,
    "sink_dynamic_overwrite": sink_dynamic_overwrite,
    "materialize_layers": materialize_layers,
    "stg_trips": stg_trips,
    "stg_zones": stg_zones,
    # projections
    "fn_pickup_date": fn_pickup_date,
    "fn_pickup_month": fn_pickup_month,
    "fn_year_month": fn_year_month,
    "fn_pickup_hour": fn_pickup_hour,
    "fn_day_name": fn_day_name,
    "fn_duration_boundary_min": fn_duration_boundary_min,
    "fn_duration_elapsed_min": fn_duration_elapsed_min,
    "fn_tip_percentage": fn_tip_percentage,
    "fn_average_speed": fn_average_speed,
    "fn_is_weekend": fn_is_weekend,
    "fn_distance_bucket": fn_distance_bucket,
    "fn_period_label": fn_period_label,
    "fn_round2": fn_round2,
    "fn_casts": fn_casts,
    "model_trip_metrics": model_trip_metrics,
    "fn_guarded_ratio": fn_guarded_ratio,
    # filters
    "filter_positive_total": filter_positive_total,
    "filter_month_not_null": filter_month_not_null,
    "filter_tip_not_null": filter_tip_not_null,
    "filter_clean_trips": filter_clean_trips,
    "topk_zones_by_rank": topk_zones_by_rank,
    "topk_either_end": topk_either_end,
    "filter_min_support": filter_min_support,
    "dq_valid_trip_duration": dq_valid_trip_duration,
    # joins
    "join_pickup_zone": join_pickup_zone,
    "join_salted": join_salted,
    "model_trip_enriched": model_trip_enriched,
    "join_self_aggregate": join_self_aggregate,
    # aggregations
    "agg_zone_month": agg_zone_month,
    "mart_demand_timing": mart_demand_timing,
    "mart_tip_behaviour": mart_tip_behaviour,
    "agg_daily_zone": agg_daily_zone,
    "reagg_annual_revenue": reagg_annual_revenue,
    "reagg_avg_of_avg": reagg_avg_of_avg,
    "row_counts": row_counts,
    # windows
    "mart_zone_revenue": mart_zone_revenue,
    "rank_annual_revenue": rank_annual_revenue,
    "rank_peak_trough": rank_peak_trough,
    "rank_tip_high_low": rank_tip_high_low,
    # reports
    "report_zone_revenue": report_zone_revenue,
    "report_demand_timing": report_demand_timing,
    "report_tip_behaviour": report_tip_behaviour,
    "job_daily_zone": job_daily_zone,
    "job_daily_ledger": job_daily_ledger,
    "stream_daily_zone": stream_daily_zone,
    "pipeline_publish": pipeline_publish,
    "pipeline_by_name": pipeline_by_name,
    # data quality
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_unique_order_line": dq_unique_order_line,
    "dq_summary": dq_summary,
    "dq_freshness": dq_freshness,
    "dq_source_status": dq_source_status,
    "dq_file_manifest": dq_file_manifest,
}
