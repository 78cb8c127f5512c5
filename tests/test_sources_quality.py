"""Loaders, sinks, quality checks, negative data."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from farebox.operators import quality
from farebox.plans import pipeline
from farebox.sources import semistructured, sinks, trip_files, zone_csv
from farebox.fixtures import star_trips, star_zones, to_file_layout
from farebox.plans import models
from conftest import SF001

T = dt.datetime


def test_zone_csv_positional_quoted(spark, tmp_out):
    p = os.path.join(tmp_out, "zones.csv")
    with open(p, "w") as f:
        f.write('LocationID,Borough,Zone,service_zone\n1,"X","Y, z",\n2,B,"Q ""q""",SZ\n')
    rows = zone_csv.load_zones(spark, p, as_of="2024-01-01 00:00:00").orderBy("location_id").collect()
    assert tuple(rows[0])[:4] == (1, "X", "Y, z", None)
    assert rows[1].zone == 'Q "q"'
    assert rows[0].loaded_at == T(2024, 1, 1)


def test_zone_csv_failfast_raises(spark, tmp_out):
    p = os.path.join(tmp_out, "bad.csv")
    with open(p, "w") as f:
        f.write("id,a,b,c\nxx,1,2,3\n")
    with pytest.raises(Exception):
        zone_csv.load_zones(spark, p).collect()
    assert zone_csv.read_zones_csv(spark, p, failfast=False).count() == 1


@pytest.mark.parametrize("bad", ["xx,1,2,3", "2,b", "2,b,c,d,e"])
def test_zone_csv_failfast_raises_for_any_projection(spark, tmp_out, bad):
    p = os.path.join(tmp_out, "bad.csv")
    with open(p, "w") as f:
        f.write(f"id,a,b,c\n1,B,Z,S\n{bad}\n")
    for use in (lambda z: z.count(), lambda z: z.select("zone").collect()):
        with pytest.raises(Exception):
            use(zone_csv.load_zones(spark, p))


def test_field_that_only_some_files_have_is_loaded(spark, tmp_out):
    base = "VendorID bigint, PULocationID bigint, trip_distance double"
    spark.createDataFrame([(1, 7, 2.0)], base).write.parquet(
        os.path.join(tmp_out, "yellow_tripdata_2023-01.parquet"))
    spark.createDataFrame([(1, 8, 2.0, 1.25)], base + ", Airport_fee double").write.parquet(
        os.path.join(tmp_out, "yellow_tripdata_2023-02.parquet"))
    rows = trip_files.load_trips(spark, os.path.join(tmp_out, "*.parquet"), as_of="2024-01-01")
    assert sorted(r.airport_fee or 0.0 for r in rows.collect()) == [0.0, 1.25]


def test_files_whose_types_differ_are_loaded(spark, tmp_out):
    def written(month, fields, row):
        p = os.path.join(tmp_out, f"yellow_tripdata_2023-{month}.parquet")
        spark.createDataFrame([row], fields).write.parquet(p)

    written("01", "VendorID int, PULocationID int, passenger_count double", (1, 7, 2.5))
    written("02", "VendorID bigint, PULocationID bigint, passenger_count bigint, Airport_fee double",
            (1, 8, 3, 1.25))
    written("03", "VendorID int, PULocationID int, passenger_count double, airport_fee double",
            (1, 9, None, 0.5))
    path = os.path.join(tmp_out, "*.parquet")
    assert len(trip_files.trip_layouts(spark, path)) == 2
    rows = trip_files.load_trips(spark, path, as_of="2024-01-01").collect()
    assert sorted((r.pu_location_id, r.passenger_count, r.airport_fee) for r in rows) == [
        (7, 3, None), (8, 3, 1.25), (9, None, 0.5)]
    with pytest.raises(ValueError, match="trip_distance"):
        trip_files.load_trips(spark, path, strict=True)


def test_path_rounds_once(spark):
    df = spark.createDataFrame([('{"k":0.4999999}',), ('{"k":0.5}',), ('{"k":1.49}',)], "j string")
    assert [r[0] for r in df.select(semistructured.extract_path("j", "$.k", "int")).collect()] == [0, 1, 1]


def test_typed_load_case_insensitive_and_missing_fields(spark, tmp_out):
    p = os.path.join(tmp_out, "yellow_tripdata_2023-01.parquet")
    df = spark.createDataFrame(
        [(1, 1672567200000000, 1672567260000000, 2.5, 1.0, 7, 1.25)],
        "VendorID bigint, tpep_pickup_datetime bigint, tpep_dropoff_datetime bigint, "
        "passenger_count double, trip_distance double, PULocationID bigint, airport_fee double")
    df.write.parquet(p)
    r = trip_files.load_trips(spark, os.path.join(tmp_out, "yellow_tripdata_2023-*.parquet"),
                              as_of="2024-01-01").first()
    assert r.tpep_pickup_datetime == T(2023, 1, 1, 10, 0, 0)
    assert r.passenger_count == 3  # 2.5 rounds half-up
    assert r.pu_location_id == 7 and r.airport_fee == 1.25
    assert r.fare_amount is None and r.do_location_id is None
    assert r.source_file.startswith("part-")


def test_extract_path(spark):
    df = spark.createDataFrame([('{"k": 1.5, "s": "x"}',), ('{"z": 1}',)], "j string")
    out = df.select(semistructured.extract_path("j", "$.k", "int").alias("k"),
                    semistructured.extract_path("j", "$.s", "string").alias("s")).collect()
    assert [tuple(r) for r in out] == [(2, "x"), (None, None)]


def test_epoch_micros_roundtrip(spark):
    df = spark.createDataFrame([(T(2024, 1, 1, 0, 0, 7, 179575),)], "ts timestamp_ntz")
    r = df.select(trip_files.ts_to_epoch_micros("ts").alias("u")).select(
        "u", trip_files.epoch_micros_to_ts("u").alias("back")).first()
    assert r.u == 1704067207179575 and r.back == T(2024, 1, 1, 0, 0, 7, 179575)


def test_dynamic_overwrite_keeps_other_months(spark, tmp_out):
    p = os.path.join(tmp_out, "daily")
    df = spark.createDataFrame([(2023, 1, 10), (2023, 2, 20)], "pickup_year int, pickup_month int, v int")
    sinks.write_partitioned(df, p, ["pickup_year", "pickup_month"])
    sinks.write_partitioned(spark.createDataFrame([(2023, 2, 99)], df.schema), p,
                            ["pickup_year", "pickup_month"])
    got = sorted(tuple(r) for r in spark.read.parquet(p).select("pickup_month", "v").collect())
    assert got == [(1, 10), (2, 99)]
    # static mode replaces everything
    sinks.write_partitioned(spark.createDataFrame([(2023, 3, 5)], df.schema), p,
                            ["pickup_year", "pickup_month"], dynamic=False)
    assert [r.v for r in spark.read.parquet(p).collect()] == [5]


def test_hot_partition_is_split_over_tasks(spark, tmp_out):
    p = os.path.join(tmp_out, "rebalanced")
    df = spark.range(200000).select(F.lit(2023).alias("y"),
                                    F.when(F.col("id") < 190000, 1).otherwise(2).alias("m"), "id")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        sinks.write_partitioned(df, p, ["y", "m"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert spark.read.parquet(p).count() == 200000
    hot = [f for f in os.listdir(os.path.join(p, "y=2023", "m=1")) if f.endswith(".parquet")]
    assert len(hot) > 1


def test_full_refresh_is_idempotent(spark, tmp_out):
    p = os.path.join(tmp_out, "t")
    df = spark.range(10)
    sinks.write_table(df, p)
    sinks.write_table(df, p)
    assert spark.read.parquet(p).count() == 10


def test_unique_and_not_null(spark):
    z = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "location_id int, zone string")
    assert [tuple(r) for r in quality.unique_violations(z, ["location_id"]).collect()] == [(1, 2)]
    nn = {r.column_name: r.failures for r in quality.not_null_failures(z, ["location_id", "zone"]).collect()}
    assert nn == {"location_id": 1, "zone": 0}


def test_quality_summary_statuses(spark):
    trips = models.stg_trips(star_trips(spark, SF001))
    zones = models.stg_zones(star_zones(spark, SF001))
    rows = {(r.test_name, r.column_name): (r.failures, r.status)
            for r in quality.quality_summary(trips, zones).collect()}
    assert rows[("valid_trip_duration", None)] == (225, "warn")
    assert rows[("unique", "location_id")] == (0, "pass")
    assert rows[("not_null", "tpep_pickup_datetime")][1] == "error"  # NULL pickups exist
    assert len(rows) == 8


@pytest.mark.parametrize("age,status", [(dt.timedelta(days=1), "pass"),
                                        (dt.timedelta(days=1, seconds=1), "warn"),
                                        (dt.timedelta(days=2, seconds=1), "error")])
def test_freshness(spark, age, status):
    newest = T(2024, 1, 1)
    df = spark.createDataFrame([(newest,), (T(2023, 1, 1),)], "loaded_at timestamp_ntz")
    r = quality.freshness(df, "loaded_at", str(newest + age), "src").first()
    assert r.status == status and r.age_seconds == int(age.total_seconds())


def test_freshness_empty_is_error(spark):
    df = spark.createDataFrame([], "loaded_at timestamp_ntz")
    assert quality.freshness(df, "loaded_at", "2024-01-01", "src").first().status == "error"


def test_file_manifest_collects_all_errors(spark, tmp_out):
    raw = os.path.join(tmp_out, "raw")
    os.makedirs(raw)
    for m in ("01", "02"):
        spark.range(3).write.parquet(os.path.join(tmp_out, "tmp" + m))
        src = [f for f in os.listdir(os.path.join(tmp_out, "tmp" + m)) if f.endswith(".parquet")][0]
        os.rename(os.path.join(tmp_out, "tmp" + m, src), os.path.join(raw, f"yellow_tripdata_2023-{m}.parquet"))
    open(os.path.join(raw, "yellow_tripdata_2023-03.parquet"), "w").close()
    lookup = os.path.join(tmp_out, "missing.csv")
    r = quality.file_manifest(spark, raw, "yellow_tripdata_2023-*.parquet", lookup, 12).first()
    assert r.parquet_file_count == 3
    assert r.empty_files == ["yellow_tripdata_2023-03.parquet"]
    assert len(r.errors) == 3 and not r.lookup_file_exists
    with pytest.raises(quality.FileValidationError) as e:
        quality.validate_files(spark, raw, "yellow_tripdata_2023-*.parquet", lookup, 12)
    assert [(p["problem"], p["wanted"], p["found"]) for p in e.value.problems] == [
        ("file count", "12", "3"), ("lookup", "1", "0"), ("file size", "> 0", "0")]
    assert "file count" in str(e.value) and lookup in str(e.value)


def test_pipeline_gate_blocks_publish(spark, tmp_out):
    trips = star_trips(spark, SF001)
    zones = star_zones(spark, SF001)
    with pytest.raises(quality.DataQualityError):
        pipeline.run(spark, trips, zones, tmp_out)
    assert not os.path.exists(os.path.join(tmp_out, "marts"))


def test_pipeline_publishes_marts(spark, tmp_out):
    trips = star_trips(spark, SF001).filter(
        F.col("tpep_pickup_datetime").isNotNull() & F.col("pu_location_id").isNotNull())
    res = pipeline.run(spark, trips, star_zones(spark, SF001), tmp_out)
    assert res.tables["mart_demand_timing"].count() == spark.read.parquet(
        os.path.join(tmp_out, "marts", "mart_demand_timing")).count()
    assert any(r.status == "warn" for r in res.quality)


def test_checkpoint_dir_comes_from_session(spark):
    from farebox.session import checkpoint_dir, scratch_path
    d = checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(d.rstrip("/") + "/farebox-scratch/x-")


def test_run_from_files_end_to_end(spark, tmp_out):
    raw = os.path.join(tmp_out, "raw")
    trips = star_trips(spark, SF001).filter(
        F.col("tpep_pickup_datetime").isNotNull() & F.col("pu_location_id").isNotNull())
    staging = os.path.join(tmp_out, "staging")
    to_file_layout(trips).repartition(2).write.parquet(staging)
    os.makedirs(raw)
    for i, f in enumerate(sorted(p for p in os.listdir(staging) if p.endswith(".parquet"))):
        os.rename(os.path.join(staging, f), os.path.join(raw, f"yellow_tripdata_2023-{i + 1:02d}.parquet"))
    zpath = os.path.join(tmp_out, "zones")
    zone_csv.write_zones_csv(star_zones(spark, SF001), zpath)
    with pytest.raises(quality.FileValidationError):
        pipeline.run_from_files(spark, raw, zpath, os.path.join(tmp_out, "out"))
    res = pipeline.run_from_files(spark, raw, zpath, os.path.join(tmp_out, "out"),
                                  expected_files=2, as_of="2024-01-01 00:00:00")
    assert res.tables["int_trip_enriched"].count() == trips.count()
    assert spark.table("mart_zone_revenue").count() == res.tables["mart_zone_revenue"].count()
