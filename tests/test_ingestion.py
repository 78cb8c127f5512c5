"""Trip files that differ, loads and releases that are all or nothing, spread joins,
file statistics and the incremental daily job."""

import contextlib
import datetime as dt
import io
import os
import statistics as st

import pytest
from pyspark.sql import functions as F

from farebox.fixtures import star_trips, star_zones, to_file_layout
from farebox.operators import joins
from farebox.plans import daily, daily_ledger, marts, models, pipeline, reports
from farebox.schemas import TRIP_FIELDS
from farebox.sources import footers, releases, trip_files
from farebox.sources import statistics as table_statistics
from conftest import SF001

T = dt.datetime


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def files(spark):
    return to_file_layout(star_trips(spark, SF001)).persist()


# --- files that differ ---------------------------------------------------------

def test_a_file_without_a_needed_field_is_named(spark, files, tmp_out):
    files.limit(4).write.parquet(f"{tmp_out}/whole.parquet")
    files.limit(3).drop("total_amount").write.parquet(f"{tmp_out}/short.parquet")
    files.limit(2).drop("total_amount", "Airport_fee").write.parquet(f"{tmp_out}/shorter.parquet")
    with pytest.raises(trip_files.TripFileError) as e:
        daily.run_daily_job(spark, f"{tmp_out}/*.parquet", f"{tmp_out}/out")
    assert "short.parquet" in str(e.value) and "shorter.parquet" in str(e.value)
    assert "whole.parquet" not in str(e.value) and "total_amount" in str(e.value)
    assert not os.path.exists(f"{tmp_out}/out")
    with pytest.raises(trip_files.TripFileError, match="shorter.parquet/.* lacks total_amount"):
        trip_files.load_trips(spark, f"{tmp_out}/*.parquet", strict=True)
    loaded = trip_files.load_trips(spark, f"{tmp_out}/*.parquet")
    assert loaded.count() == 9 and loaded.where("total_amount is null").count() >= 5
    named = footers.lacking(footers.footers(spark, f"{tmp_out}/*.parquet"), ["TOTAL_amount"])
    assert {os.path.basename(os.path.dirname(r.file)) for r in named.collect()} == {
        "short.parquet", "shorter.parquet"}


def test_one_job_whatever_the_layouts(spark, files, tmp_out):
    few = files.limit(2).persist()
    def jobs(path):
        sc = spark.sparkContext
        sc.setJobGroup(path, "layouts")
        try:
            found = trip_files.trip_layouts(spark, path)
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        return len(found), len(sc.statusTracker().getJobIdsForGroup(path))

    few.write.parquet(f"{tmp_out}/one/0")
    kinds = ["bigint", "double", "string", "int", "float"]
    for k in range(10):                           # layouts that alternate file by file
        few.withColumn("passenger_count", F.col("passenger_count").cast(kinds[k % 5])).write.parquet(
            f"{tmp_out}/many/{k}")
    (n_one, jobs_one), (n_many, jobs_many) = jobs(f"{tmp_out}/one/*"), jobs(f"{tmp_out}/many/*")
    assert (n_one, n_many) == (1, 5) and jobs_one == jobs_many


def test_footers_of_foreign_files(spark, tmp_out):
    import pyarrow as pa
    import pyarrow.parquet as pq
    table = pa.table({"VendorID": pa.array([1, 2], pa.uint32()), "fare_amount": pa.array([1.0, 2.5]),
                      "tpep_pickup_datetime": pa.array([T(2023, 1, 1)] * 2, pa.timestamp("us")),
                      "extra": pa.array([1, 2], pa.int8()), "other": pa.array([[1], []])})
    pq.write_table(table, f"{tmp_out}/a.parquet")
    pq.write_table(table.select([]), f"{tmp_out}/none.parquet")
    rows = footers.footers(spark, tmp_out).collect()
    assert {(r.field, r.type, r.row_count) for r in rows if r.file.endswith("a.parquet")} == {
        ("VendorID", "bigint", 2), ("fare_amount", "double", 2), ("extra", "tinyint", 2),
        ("tpep_pickup_datetime", "timestamp_ntz", 2), ("other", "list<element: int64>", 2)}
    assert [(r.field, r.type) for r in rows if r.file.endswith("none.parquet")] == [(None, None)]
    assert sorted(map(tuple, footers.footers(spark, tmp_out, whole=True).collect()), key=str) == sorted(
        map(tuple, rows), key=str)
    got = trip_files.load_trips(spark, f"{tmp_out}/a.parquet").orderBy("vendor_id").collect()
    assert [(r.vendor_id, r.fare_amount, r.extra) for r in got] == [(1, 1.0, 1.0), (2, 2.5, 2.0)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_one_bad_value_aborts_the_whole_load(spark, files, tmp_out, ansi):
    files.limit(5).write.parquet(f"{tmp_out}/good")
    files.limit(1).withColumn("passenger_count", F.lit("abc")).write.parquet(f"{tmp_out}/bad")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="passenger_count of trip file .* can't be loaded: abc"):
            trip_files.load_trips(spark, f"{tmp_out}/*").count()
        # a lazy scan fails only where the value is used
        assert trip_files.scan_trips(spark, f"{tmp_out}/*").select("vendor_id").count() == 6
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert trip_files.load_trips(spark, f"{tmp_out}/good").count() == 5


def test_epoch_micros_in_any_session_zone(spark):
    df = spark.createDataFrame([(0,), (-1,), (1_678_588_200_000_001,), (None,)], "u bigint")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("America/New_York", "Asia/Kolkata", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", z)
            rows = df.select("u", trip_files.epoch_micros_to_ts("u").alias("t")).select(
                "u", "t", trip_files.ts_to_epoch_micros("t").alias("back")).collect()
            assert [r.t for r in rows] == [T(1970, 1, 1), T(1969, 12, 31, 23, 59, 59, 999999),
                                           T(2023, 3, 12, 2, 30, 0, 1), None]
            assert [r.back for r in rows] == [r.u for r in rows]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


# --- releases -------------------------------------------------------------------

def test_a_failed_run_leaves_the_release_before_it(spark, tmp_out, monkeypatch):
    trips, zones = star_trips(spark, SF001), star_zones(spark, SF001)
    pipeline.run(spark, trips, zones, tmp_out, gate=False)
    before = {m: releases.read_table(spark, tmp_out, "marts", m).collect() for m in pipeline.MARTS}
    first = releases.current(spark, tmp_out)

    def broken(enriched):
        raise RuntimeError("third mart")

    monkeypatch.setitem(pipeline.MARTS, "mart_tip_behaviour", broken)
    with pytest.raises(RuntimeError, match="third mart"):
        pipeline.run(spark, trips.limit(10), zones, tmp_out, gate=False)
    assert releases.current(spark, tmp_out) == first
    other = spark.newSession()
    for m, rows in before.items():
        for table in (releases.read_table(spark, tmp_out, "marts", m), other.table(f"marts.{m}")):
            assert sorted(map(str, table.collect())) == sorted(map(str, rows))
    monkeypatch.undo()
    pipeline.run(spark, trips.limit(10), zones, tmp_out, gate=False)
    assert releases.current(spark, tmp_out).seq == first.seq + 1
    assert other.table("staging.stg_yellow_taxi_trips").count() == 10
    assert other.table("intermediate.int_trip_enriched").count() == 10
    assert other.table("staging.stg_yellow_taxi_trips").columns == models.STG_TRIP_COLUMNS
    # a table whose columns change is named anew
    release = releases.Release(spark, tmp_out)
    release.write(spark.range(3), "marts", "mart_zone_revenue")
    release.commit()
    releases.register(spark, tmp_out)
    assert spark.newSession().table("marts.mart_zone_revenue").columns == ["id"]


def test_nothing_released(spark, tmp_out):
    assert releases.current(spark, tmp_out) is None
    with pytest.raises(LookupError):
        releases.read_table(spark, tmp_out, "marts", "mart_zone_revenue")
    with pytest.raises(LookupError):
        releases.register(spark, tmp_out)


# --- statistics -----------------------------------------------------------------

def test_counts_and_load_times_come_from_footers(spark, tmp_out):
    day = T(2024, 1, 1)
    def table(name, *times):
        df = spark.createDataFrame([(t,) for t in times], "loaded_at timestamp_ntz")
        table_statistics.with_load_micros(df).write.parquet(f"{tmp_out}/{name}")
        return f"{tmp_out}/{name}"

    paths = {"old": table("old", T(2023, 12, 1), T(2023, 12, 29)), "fresh": table("fresh", day),
             "late": table("late", T(2023, 12, 30, 12)), "none": table("none"),
             "future": table("future", day + dt.timedelta(seconds=1))}
    found = table_statistics.load_statistics(spark, paths)
    plan = _plan(found)
    assert "PushedAggregation: [COUNT(*), MAX(loaded_at_micros)]" in plan
    rows = {r.source: (r.row_count, r.max_loaded_at, r.status)
            for r in table_statistics.source_status(found, str(day)).collect()}
    assert rows == {"old": (2, T(2023, 12, 29), "error"), "fresh": (1, day, "pass"),
                    "late": (1, T(2023, 12, 30, 12), "warn"), "none": (0, None, "error"),
                    "future": (1, day + dt.timedelta(seconds=1), "future")}
    assert "BatchScan" not in _plan(spark.read.parquet(paths["old"]))   # the caller's scans stay


def test_pipeline_reports_its_sources(spark, tmp_out):
    res = pipeline.run(spark, star_trips(spark, SF001), star_zones(spark, SF001), tmp_out,
                       gate=False, as_of="2024-01-01 12:00:00")
    assert {r.source: (r.row_count, r.status) for r in res.sources} == {
        "yellow_taxi_trips": (6000, "error"), "taxi_zone_lookup": (25, "pass")}


# --- spread joins ---------------------------------------------------------------

def test_hot_and_null_keys_are_spread(spark):
    n = 60_000
    facts = spark.range(n).select(
        F.col("id").alias("trip"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 5 == 0, F.lit(None).cast("int"))
        .otherwise((F.col("id") % 9973).cast("int")).alias("zone_id"))
    dim = spark.range(10_000).select(F.col("id").cast("int").alias("zone_id"),
                                     F.concat(F.lit("z"), "id").alias("zone"))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def loads(**more):
            joined = joins.lookup_join(facts, dim, "zone_id", "zone_id", {"zone": "zone"}, **more)
            assert "BroadcastHashJoin" not in _plan(joined)
            per_task = joined.groupBy(F.spark_partition_id()).count().collect()
            return joined, [r["count"] for r in per_task]

        hot = joins.hot_keys(facts, "zone_id")
        assert hot == [7]
        plain, uneven = loads()
        spread, even = loads(hot=hot)
        assert max(uneven) > 2 * st.median(uneven)
        assert len(even) == 8 and max(even) <= 2 * st.median(even) and sum(even) == n
        assert _same(plain, spread)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        for k in keys:
            spark.conf.unset(k)


def test_salted_enrichment_equals_the_plain_one(spark):
    trips = models.trip_metrics(models.stg_trips(star_trips(spark, SF001)))
    zones = models.stg_zones(star_zones(spark, SF001))
    twice = zones.unionByName(zones.where("location_id = 1"))
    for z in (zones, twice, zones.limit(0)):
        assert _same(models.trip_enriched(trips, z), models.trip_enriched(trips, z, salted=True))


# --- the daily job over a growing set of files --------------------------------------

def _partition_files(out):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(out) for f in names if f.endswith(".parquet")}


def test_a_late_file_rewrites_its_month_only(spark, files, tmp_out):
    src, out, ledger = (f"{tmp_out}/{x}" for x in ("in", "out", "ledger"))
    month = F.date_format("tpep_pickup_datetime", "yyyy-MM")
    early, late = files.where(month < "1995-06"), files.where(month == "1995-03")
    some = late.limit(7).persist()
    early.exceptAll(some).write.parquet(f"{src}/a.parquet")
    assert daily_ledger.update_daily(spark, f"{src}/*.parquet", out, ledger) == [
        199500 + m for m in range(1, 6)]
    assert daily_ledger.update_daily(spark, f"{src}/*.parquet", out, ledger) == []
    before = _partition_files(out)
    some.write.parquet(f"{src}/late one.parquet")
    assert daily_ledger.update_daily(spark, f"{src}/*.parquet", out, ledger) == [199503]
    after = _partition_files(out)
    changed = {os.path.dirname(f) for f in set(before.items()) ^ set(after.items()) for f in f[:1]}
    assert {c.removeprefix(out) for c in changed} == {"/pickup_year=1995/pickup_month=3"}

    def full():
        df = daily.daily_zone(daily.clean_trips(daily.read_trip_files(spark, f"{src}/*.parquet")))
        got = spark.read.schema(df.schema).parquet(out)
        return _same(got.select(*sorted(df.columns)), df.select(*sorted(df.columns)))

    assert full()
    # a file that is replaced touches its old months and its new ones
    files.where(month == "1995-05").limit(3).write.mode("overwrite").parquet(f"{src}/late one.parquet")
    spark.catalog.clearCache()
    assert daily_ledger.update_daily(spark, f"{src}/*.parquet", out, ledger) == [199503, 199505]
    assert full()
    # rows that the job doesn't count touch no month
    files.limit(3).withColumn("total_amount", F.lit(0.0)).write.parquet(f"{src}/none.parquet")
    assert daily_ledger.update_daily(spark, f"{src}/*.parquet", out, ledger) == []


# --- order of the reports ---------------------------------------------------------

def test_reports_come_in_their_order(spark):
    enriched = models.trip_enriched(models.trip_metrics(models.stg_trips(star_trips(spark, SF001))),
                                    models.stg_zones(star_zones(spark, SF001)))
    r1 = [(r.annual_revenue_rank, r.pickup_month) for r in
          reports.zone_revenue_report(marts.zone_revenue(enriched)).collect()]
    assert len(r1) > 700 and r1 == sorted(r1)
    mart = spark.createDataFrame(
        [(z, "B", f"Z{z}", 1, "0-1 miles", 100 + z, 1.0, float(z % 7), 1.0, 1.0) for z in range(40)],
        marts.tip_behaviour(enriched).schema.simpleString()[7:-1].replace(":", " "))
    r3 = [r.avg_tip_percentage for r in reports.tip_behaviour_report(mart).collect()]
    assert len(r3) > 20 and r3 == sorted(r3, reverse=True)


def test_file_layout_names_every_field(files):
    assert files.columns == [f for _, _, f in TRIP_FIELDS]
