"""The daily pipeline as one Spark application:
load -> quality gate -> models -> marts -> publish.

Unlike a run-then-test flow, the declared tests run on the staging layer before
the models are built, so error-severity failures never publish. All tables of a run
become current together, see ``farebox.sources.releases``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from farebox.operators import quality
from farebox.plans import marts, models
from farebox.schemas import STG_TRIP_COLUMNS, STG_ZONE_COLUMNS
from farebox.session import configure
from farebox.sources import releases, statistics

MARTS = {
    "mart_zone_revenue": marts.zone_revenue,
    "mart_demand_timing": marts.demand_timing,
    "mart_tip_behaviour": marts.tip_behaviour,
}
RAW_TRIPS, RAW_ZONES = ("raw", "yellow_taxi_trips"), ("raw", "taxi_zone_lookup")
STAGING_VIEWS = {
    ("staging", "stg_yellow_taxi_trips"): (RAW_TRIPS, STG_TRIP_COLUMNS),
    ("staging", "stg_taxi_zone_lookup"): (RAW_ZONES, STG_ZONE_COLUMNS),
}


@dataclass
class PipelineResult:
    quality: list = field(default_factory=list)
    sources: list = field(default_factory=list)
    tables: dict[str, DataFrame] = field(default_factory=dict)


def run(spark: SparkSession, raw_trips: DataFrame, raw_zones: DataFrame, out_dir: str,
        gate: bool = True, as_of: str | None = None) -> PipelineResult:
    """Load, check, build and publish all tables below ``out_dir``, all or nothing.

    The raw tables are written first, in one job each, so a bad value anywhere fails
    the run, and every later step reads the same rows. With ``gate`` an
    error-severity test failure raises ``DataQualityError`` before any model is
    built; warnings are returned. With ``as_of`` the sources' row counts and
    freshness, taken from the files' statistics, are returned as well. The enriched
    model is written once, as its three consumers share it; the metrics model stays
    a view. Only when every table is there does the run become the current release;
    then the tables get their names (``raw``, ``intermediate`` and ``marts``, views
    on the raw tables in ``staging``) and session views without a layer."""
    configure(spark)
    release = releases.Release(spark, out_dir)
    raw_t = release.write(statistics.with_load_micros(raw_trips), *RAW_TRIPS)
    raw_z = release.write(statistics.with_load_micros(raw_zones), *RAW_ZONES)
    sources = []
    if as_of is not None:
        paths = {name: releases.table_path(out_dir, layer, name, release.run_id)
                 for layer, name in (RAW_TRIPS, RAW_ZONES)}
        sources = statistics.source_status(
            statistics.load_statistics(spark, paths), as_of).collect()   # one row per source
    stg_t, stg_z = models.stg_trips(raw_t), models.stg_zones(raw_z)
    rows = quality.quality_summary(stg_t, stg_z).collect()  # one row per declared test
    if gate:
        quality.raise_on_errors(rows)
    enriched = release.write(models.trip_enriched(models.trip_metrics(stg_t), stg_z),
                             "intermediate", "int_trip_enriched")
    tables = {"int_trip_enriched": enriched}
    for name, build in MARTS.items():
        tables[name] = release.write(build(enriched), "marts", name)
    release.commit()
    releases.register(spark, out_dir, STAGING_VIEWS)
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return PipelineResult(quality=rows, sources=sources, tables=tables)


def run_from_files(spark: SparkSession, trip_dir: str, zone_csv_path: str, out_dir: str,
                   trip_pattern: str = "yellow_tripdata_2023-*.parquet",
                   expected_files: int | None = 12, as_of: str | None = None,
                   gate: bool = True) -> PipelineResult:
    """The whole daily flow from files: check the input manifest (all
    problems reported together), scan trips and zones with their fixed
    schemas, then ``run``, which loads them. ``expected_files=None`` skips the
    count check."""
    from farebox.sources.trip_files import scan_trips, stamp_loaded_at
    from farebox.sources.zone_csv import load_zones

    configure(spark)

    if expected_files is not None:
        quality.validate_files(spark, trip_dir, trip_pattern, zone_csv_path, expected_files)
    trips = stamp_loaded_at(
        scan_trips(spark, f"{trip_dir.rstrip('/')}/{trip_pattern}", strict=True), as_of)
    zones = load_zones(spark, zone_csv_path, as_of=as_of)
    return run(spark, trips, zones, out_dir, gate=gate, as_of=as_of)


def main(argv: list[str] | None = None) -> None:
    """``python -m farebox.plans.pipeline TRIP_DIR ZONE_CSV OUT_DIR [EXPECTED_FILES]``:
    validate, load, gate, build and publish; prints the quality status rows."""
    import sys

    args = sys.argv[1:] if argv is None else argv
    if len(args) not in (3, 4):
        raise SystemExit("usage: python -m farebox.plans.pipeline TRIP_DIR ZONE_CSV OUT_DIR "
                         "[EXPECTED_FILES]")
    spark = configure(SparkSession.builder.appName("farebox-pipeline").getOrCreate())
    expected = int(args[3]) if len(args) == 4 else 12
    result = run_from_files(spark, args[0], args[1], args[2], expected_files=expected)
    for row in result.sources + result.quality:
        print(row.asDict())


if __name__ == "__main__":
    main()
