"""Incremental daily job: equals the batch job, survives replays."""

import os

import pytest
from pyspark.sql import functions as F

from farebox.fixtures import star_trips, to_file_layout
from farebox.plans import daily
from farebox.streaming import daily_incremental as inc
from conftest import SF001


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_matches_batch_and_is_idempotent(spark, tmp_path):
    src = str(tmp_path / "in")
    to_file_layout(star_trips(spark, SF001)).repartition(3).write.parquet(src)
    schema = spark.read.parquet(src).schema
    parts, ckpt = str(tmp_path / "partials"), str(tmp_path / "ckpt")

    q = inc.start(spark, src, schema, parts, ckpt, files_per_batch=1, path_glob="part-*.parquet")
    q.awaitTermination()
    batch = daily.daily_zone_from_files(spark.read.parquet(src))
    streamed = inc.read_daily(spark, parts)
    assert _same(streamed, batch)
    n_batches = spark.read.parquet(parts).select("batch_id").distinct().count()
    assert n_batches == 3

    # Restart on the same checkpoint with no new files: nothing is added.
    q = inc.start(spark, src, schema, parts, ckpt, files_per_batch=1, path_glob="part-*.parquet")
    q.awaitTermination()
    assert _same(inc.read_daily(spark, parts), batch)

    # A replayed batch (same id, same input) replaces its own partition.
    first_file = sorted(f for f in os.listdir(src) if f.startswith("part-"))[0]
    replay = daily.clean_trips(daily.scan_trips_pruned(spark.read.parquet(os.path.join(src, first_file))))
    ids = [r.batch_id for r in spark.read.parquet(parts).select("batch_id").distinct().collect()]
    target = min(ids)
    before = spark.read.parquet(parts).filter(F.col("batch_id") == target).count()
    inc.write_partials(replay, target, parts)
    inc.write_partials(replay, target, parts)
    after = spark.read.parquet(parts)
    assert after.select("batch_id").distinct().count() == 3
    assert after.filter(F.col("batch_id") == target).agg(F.sum("trip_count")).first()[0] == \
        replay.count()
    assert before > 0


def test_a_new_checkpoint_over_old_partials_is_an_error(spark, tmp_path):
    src, parts = str(tmp_path / "in"), str(tmp_path / "partials")
    to_file_layout(star_trips(spark, SF001)).limit(50).write.parquet(src)
    schema = spark.read.parquet(src).schema
    inc.start(spark, src, schema, parts, str(tmp_path / "one")).awaitTermination()
    with pytest.raises(ValueError, match="another checkpoint"):
        inc.start(spark, src, schema, parts, str(tmp_path / "two"))


def test_merge_of_partials_equals_single_aggregate(spark):
    cleaned = daily.clean_trips(daily.scan_trips_pruned(to_file_layout(star_trips(spark, SF001))))
    halves = [cleaned.filter(F.col("pickup_location_id") % 2 == k) for k in (0, 1)]
    merged = inc.merge_partials(inc.partial_daily(halves[0]).unionByName(inc.partial_daily(halves[1])))
    assert _same(merged, daily.daily_zone(cleaned))
