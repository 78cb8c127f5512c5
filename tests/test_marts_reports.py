"""Marts and reports: expected sizes, invariants and the kept quirks."""

import pytest
from pyspark.sql import functions as F

from farebox.fixtures import star_trips, star_zones
from farebox.plans import daily, marts, models, reports
from farebox.operators import quality
from conftest import SF001, SF01


@pytest.fixture(scope="module")
def layers(spark):
    out = {}
    for name, d in [("sf001", SF001), ("sf01", SF01)]:
        trips = models.stg_trips(star_trips(spark, d))
        zones = models.stg_zones(star_zones(spark, d))
        enr = models.trip_enriched(models.trip_metrics(trips), zones)
        out[name] = dict(trips=trips, zones=zones, enriched=enr)
    return out


def test_expected_sizes_sf001(layers):
    L = layers["sf001"]
    e = L["enriched"]
    assert e.count() == 6000 == L["trips"].count()
    mz = marts.zone_revenue(e)
    assert mz.count() == 794
    assert marts.demand_timing(e).count() == 169
    assert marts.tip_behaviour(e).count() == 150
    assert reports.zone_revenue_report(mz).count() == 794
    assert reports.demand_timing_report(marts.demand_timing(e)).count() == 25
    assert reports.tip_behaviour_report(marts.tip_behaviour(e)).count() == 0
    assert quality.reversed_trip_times(L["trips"]).count() == 225


def test_expected_sizes_sf01(layers):
    e = layers["sf01"]["enriched"]
    mz = marts.zone_revenue(e)
    r1 = reports.zone_revenue_report(mz)
    assert mz.count() == 2378
    assert r1.count() == 1505
    # T9: the NULL-location group takes an annual rank slot but never joins.
    assert r1.select("pu_location_id").distinct().count() == 19
    assert reports.tip_behaviour_report(marts.tip_behaviour(e)).count() == 40


def test_mart_counts_reconcile_with_filtered_trips(layers):
    e = layers["sf01"]["enriched"]
    total = e.filter((F.col("total_amount") > 0) & F.col("pickup_month").isNotNull()).count()
    assert marts.zone_revenue(e).agg(F.sum("trip_count")).first()[0] == total
    dem = e.filter(F.col("total_amount") > 0).count()
    assert marts.demand_timing(e).agg(F.sum("trip_count")).first()[0] == dem


def test_null_hour_group_is_a_trough(layers):
    r2 = reports.demand_timing_report(marts.demand_timing(layers["sf01"]["enriched"]))
    rows = r2.collect()
    null_hour = [r for r in rows if r.pickup_hour is None]
    assert len(null_hour) == 1
    assert null_hour[0].demand_period_classification == "Trough period"
    assert rows[-1].pickup_hour is None  # NULL hour sorts last


def test_tip_report_merges_ids_sharing_a_name(layers):
    mt = marts.tip_behaviour(layers["sf01"]["enriched"])
    by_id = mt.filter(F.col("pu_location_id").isin(15, 20)).select("pickup_zone").distinct().collect()
    assert [r.pickup_zone for r in by_id] == ["NATION_15"]
    summary = reports.zone_tip_summary(mt).filter(F.col("pickup_zone") == "NATION_15")
    ids = mt.filter(F.col("pickup_zone") == "NATION_15")
    assert summary.agg(F.sum("trip_count")).first()[0] == ids.agg(F.sum("trip_count")).first()[0]


def test_rank_ties_share_and_skip(spark):
    from farebox.operators.windows import rank_desc
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 3.0)], "k int, v double")
    got = sorted((r.k, r.r) for r in df.select("k", rank_desc("v").alias("r")).collect())
    assert got == [(1, 1), (2, 1), (3, 3)]


def test_avg_of_avg_is_unweighted(spark):
    mart = spark.createDataFrame(
        [(1, "Mon", False, 1, 10.0, 10.0), (1, "Tue", False, 99, 20.0, 20.0)],
        "pickup_hour int, pickup_day_name string, is_weekend boolean, trip_count bigint, "
        "avg_fare_amount double, avg_total_amount double")
    r = reports.hourly_summary(mart).first()
    assert r.avg_fare_amount == 15.0 and r.total_trips == 100


def test_reversed_trips_stay_in_marts(layers):
    e = layers["sf01"]["enriched"]
    rev = e.filter(F.col("tpep_dropoff_datetime") < F.col("tpep_pickup_datetime"))
    assert rev.count() == 2286
    kept = marts.demand_timing(rev).agg(F.sum("trip_count")).first()[0]
    assert kept == rev.filter(F.col("total_amount") > 0).count()


def test_daily_job_filters_and_size(spark):
    from farebox.fixtures import to_file_layout
    d = daily.daily_zone_from_files(to_file_layout(star_trips(spark, SF001)))
    assert d.count() == 4006
    assert d.filter(F.col("pickup_location_id").isNull()).count() == 0
    assert d.schema["pickup_month"].dataType.simpleString() == "int"


def test_shuffle_join_matches_broadcast(layers):
    L = layers["sf01"]
    metrics = models.trip_metrics(L["trips"])
    a = models.trip_enriched(metrics, L["zones"])
    spark = metrics.sparkSession
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    b = models.trip_enriched(metrics, L["zones"])
    plan = b._jdf.queryExecution().executedPlan().toString()
    for k in keys:
        spark.conf.unset(k)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_duplicate_zone_id_fans_out(spark, layers):
    L = layers["sf001"]
    dup = L["zones"].unionByName(L["zones"].filter(F.col("location_id") == 1))
    e = models.trip_enriched(models.trip_metrics(L["trips"]), dup)
    n_pick = L["trips"].filter(F.col("pu_location_id") == 1).count()
    n_drop = L["trips"].filter(F.col("do_location_id") == 1).count()
    n_both = L["trips"].filter((F.col("pu_location_id") == 1) & (F.col("do_location_id") == 1)).count()
    assert e.count() == 6000 + n_pick + n_drop + n_both


def test_tip_filter_equivalence(layers):
    """The tip mart filters on tip_amount; it must select exactly the rows
    with a non-NULL tip_percentage among positive totals."""
    e = layers["sf01"]["enriched"].filter(F.col("total_amount") > 0)
    a = e.filter(F.col("tip_percentage").isNotNull()).count()
    b = e.filter(F.col("tip_amount").isNotNull()).count()
    assert a == b


def test_topk_either_end_is_of_tip_groups(spark, monkeypatch):
    """Of 50 groups with enough trips the 20 highest and the 20 lowest, as the
    reference's report has them, and none of the group with too few trips."""
    from farebox.plans import catalog
    rows = [(i, "B", f"Z{i}", 1, "short", 1 if i == 50 else 100, 1.0, float(i), 1.0, 5.0)
            for i in range(51)]
    mart = spark.createDataFrame(
        rows, "pu_location_id int, pickup_borough string, pickup_zone string, payment_type int, "
        "distance_bucket string, trip_count bigint, avg_trip_distance double, "
        "avg_tip_percentage double, avg_tip_amount double, avg_total_amount double")
    monkeypatch.setattr(catalog, "_mart_tip", lambda spark, d: mart)
    out = catalog.topk_either_end(spark, "")
    assert out.columns[-2:] == ["highest_tip_rank", "lowest_tip_rank"]
    got = {r.pickup_zone: (r.highest_tip_rank, r.lowest_tip_rank) for r in out.collect()}
    assert got == {f"Z{i}": (50 - i, i + 1) for i in [*range(20), *range(30, 50)]}
