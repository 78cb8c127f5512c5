"""Physical-plan properties that matter at scale."""

import contextlib
import io
import re

from farebox.fixtures import star_trips, to_file_layout
from farebox.plans import catalog, daily
from conftest import SF001


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_no_python_udfs_anywhere(spark):
    # keys that read back what they wrote have no plan to look at
    written = {"stream_daily_zone", "load_trips_typed", "load_trips_mixed", "load_abort",
               "rows_per_source_file", "load_full_refresh", "job_daily_zone", "job_daily_mixed",
               "job_daily_ledger", "sink_daily_partitioned", "sink_dynamic_overwrite",
               "materialize_layers", "pipeline_publish", "pipeline_by_name", "dq_source_status"}
    for name, q in catalog.QUERIES.items():
        if name in written:
            continue
        p = plan(q(spark, SF001))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_zone_lookup_is_broadcast_and_fact_join_is_sort_merge(spark):
    p = plan(catalog.QUERIES["model_trip_enriched"](spark, SF001))
    assert p.count("BroadcastHashJoin") >= 2
    assert "SortMergeJoin" in p


def test_daily_job_scan_prunes_and_pushes(spark, tmp_path):
    path = str(tmp_path / "files")
    to_file_layout(star_trips(spark, SF001)).write.parquet(path)
    df = daily.daily_zone_from_files(spark.read.parquet(path))
    text = plan(df)
    pushed = [line for line in text.splitlines() if line.startswith("PushedFilters")][0]
    assert "IsNotNull(PULocationID)" in pushed
    assert "GreaterThan(total_amount,0.0)" in pushed
    assert "GreaterThan(trip_distance,0.0)" in pushed
    # Only the columns the aggregate needs are read.
    read_schema = [line for line in text.splitlines() if line.startswith("ReadSchema")][0]
    for unused in ("VendorID", "DOLocationID", "passenger_count", "payment_type", "Airport_fee"):
        assert unused not in read_schema


def test_marts_aggregate_partially_before_shuffle(spark):
    df = catalog.QUERIES["mart_demand_timing"](spark, SF001)
    p = df._jdf.queryExecution().executedPlan().toString()
    # an aggregate of partial counts below the last exchange, the final one above it
    final, below = p.index("functions=[count(1)"), p.index("functions=[partial_count(1)")
    assert final < p.index("Exchange hashpartitioning(pickup_hour") < below


def test_top_k_report_uses_window_group_limit_or_filter(spark):
    df = catalog.QUERIES["topk_zones_by_rank"](spark, SF001)
    p = df._jdf.queryExecution().executedPlan().toString()
    # ties at the cut are kept, and rows that can't rank are dropped before the exchange
    assert re.search(r"WindowGroupLimit .*rank\(annual_revenue#\d+\), 20, Partial", p)
    assert df.where("annual_revenue_rank > 20").count() == 0
