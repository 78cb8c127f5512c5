"""Hand rows for every semantic trap."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from farebox import functions as fx
from farebox.plans import models

T = dt.datetime


def one(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_minute_boundaries_and_elapsed(spark):
    rows = [(T(2023, 1, 1, 10, 0, 59), T(2023, 1, 1, 10, 1, 0)),
            (T(2023, 1, 1, 10, 1, 0), T(2023, 1, 1, 10, 0, 59)),
            (T(2023, 1, 1, 10, 0, 1), T(2023, 1, 1, 10, 0, 58)),
            (None, T(2023, 1, 1, 10, 0, 58))]
    out = one(spark, rows, "a timestamp_ntz, b timestamp_ntz",
              fx.minute_boundaries("a", "b"), fx.elapsed_minutes("a", "b"))
    assert [r[0] for r in out] == [1, -1, 0, None]
    assert out[0][1] == pytest.approx(1 / 60)
    assert out[3][1] is None


def test_minute_boundaries_before_epoch(spark):
    out = one(spark, [(T(1969, 12, 31, 23, 59, 59), T(1970, 1, 1, 0, 0, 0))],
              "a timestamp_ntz, b timestamp_ntz", fx.minute_boundaries("a", "b"))
    assert out == [(1,)]


def _metrics(spark, rows):
    schema = ("tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
              "trip_distance double, tip_amount double, total_amount double")
    return models.trip_metrics(spark.createDataFrame(rows, schema)).collect()


def test_speed_uses_six_decimal_hours(spark):
    r = _metrics(spark, [(T(2023, 1, 1, 10, 0, 0), T(2023, 1, 1, 10, 1, 0), 10.0, 0.0, 1.0)])[0]
    assert r.trip_duration_minutes == 1
    assert r.average_speed_mph == 599.99  # 10 / 0.016667; plain doubles give 600.0


def test_speed_null_when_no_boundary_or_reversed(spark):
    rows = [(T(2023, 1, 1, 10, 0, 1), T(2023, 1, 1, 10, 0, 58), 1.0, 0.0, 1.0),
            (T(2023, 1, 1, 10, 1, 0), T(2023, 1, 1, 10, 0, 59), 1.0, 0.0, 1.0)]
    assert [r.average_speed_mph for r in _metrics(spark, rows)] == [None, None]


def test_tip_percentage(spark):
    p = T(2023, 1, 1, 10, 0, 0)
    rows = [(p, p, 1.0, 1.0, 3.0), (p, p, 1.0, 1.0, 0.0), (p, p, 1.0, 1.0, None),
            (p, p, 1.0, None, 3.0), (p, p, 1.0, 1.0, -3.0)]
    assert [r.tip_percentage for r in _metrics(spark, rows)] == [33.33, None, None, None, None]


def test_weekend_day_name_month(spark):
    rows = [(T(2023, 1, 1, 12),), (T(2023, 1, 7, 12),), (T(2023, 1, 2, 12),), (None,),
            (T(2023, 5, 17, 1),)]
    out = one(spark, rows, "t timestamp_ntz", fx.is_weekend("t"), fx.day_name("t"),
              fx.month_start("t"), fx.month_number("t"), fx.hour_part("t"))
    assert [r[0] for r in out] == [True, True, False, False, False]
    assert out[0][1] == "Sun"
    assert out[3][1] is None
    assert out[4][2] == dt.date(2023, 5, 1) and out[4][3] == 5 and out[4][4] == 1


def test_distance_bucket_half_open_and_null(spark):
    vals = [(-1.0,), (0.99,), (1.0,), (3.0,), (5.0,), (10.0,), (None,)]
    out = [r[0] for r in one(spark, vals, "d double", fx.distance_bucket("d"))]
    assert out == ["0-1 miles", "0-1 miles", "1-3 miles", "3-5 miles", "5-10 miles",
                   "10+ miles", "10+ miles"]


def test_round2_half_up_on_decimal_value(spark):
    out = one(spark, [(1.005,), (2.675,), (-1.005,), (None,), (1e15 + 0.5,)], "x double",
              fx.round2("x"))
    assert [r[0] for r in out] == [1.01, 2.68, -1.01, None, 1e15 + 0.5]


def test_round2_rounds_once_and_keeps_special_values(spark):
    vals = [1.0049997, 0.0049996, -0.0049996, 0.005, 1e13 + 0.126, 9e9 + 0.125, float("inf")]
    out = [r[0] for r in one(spark, [(v,) for v in vals], "x double", fx.round2("x"))]
    assert out == [1.0, 0.0, 0.0, 0.01, 1e13 + 0.13, 9e9 + 0.13, float("inf")]
    nan = one(spark, [(float("nan"),)], "x double", fx.round2("x"))[0][0]
    assert nan != nan


def test_round2_matches_decimal_rule_on_random_values(spark):
    df = spark.range(200000).select(((F.rand(7) - 0.5) * 2e5).alias("x"))
    dec = F.round(F.col("x").cast("string").cast("decimal(38,18)"), 2).cast("double")
    assert df.filter(fx.round2("x") != dec).count() == 0


@pytest.mark.parametrize("vals,total", [
    ([1e13, 1e13, 0.01], 2e13 + 0.01), ([4e-7, 4e-7], 8e-7), ([0.1, 0.2, None], 0.3),
    ([1e18, 1.0, None], 1e18), ([float("inf"), 4.0], float("inf")), ([None, None], None),
    ([1e15, -1e15, 0.25], 0.25), ([4e-13, 4e-13], 8e-13), ([1e15, 0.25], 1e15 + 0.25),
    ([0.25, 4e-13], 0.2500000000004), ([1e9 + 0.1, 1 / 3, 1e-9], 1000000000.4333333343333333),
    ([-0.01, 0.03, -0.02], 0.0), ([-1e6] * 3 + [0.5], -2999999.5), ([123456789.123456] * 7, 864197523.864192),
    ([9007199254740993.0, -1.0, 1 / 3], 9007199254740991.333), ([-1e-7, -2e-7], -3e-7)])
def test_sums_and_averages_of_any_size(spark, vals, total):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = df.agg(fx.exact_sum("x").alias("s"), fx.exact_avg("x").alias("a")).first()
    n = sum(v is not None for v in vals)
    assert r.s == total and r.a == (None if total is None else total / n)


def test_sums_equal_those_of_decimals_in_any_order(spark):
    """Amounts of all sizes and digits against Python's decimals, forwards, backwards
    and merged from partial sums."""
    import decimal
    import random
    rng = random.Random(6)
    groups = []
    for g in range(60):
        top = 10.0 ** rng.randint(-9, 14)
        places = rng.choice([0, 1, 2, 4, 6, 9, 14])
        groups += [(g, round(rng.uniform(-top, top), places)) for _ in range(rng.randint(1, 60))]
    with decimal.localcontext(decimal.Context(prec=400)):
        want = {}
        for g, v in groups:
            want[g] = want.get(g, decimal.Decimal(0)) + decimal.Decimal(repr(v))
        want = {g: float(t) for g, t in want.items()}
    for rows in (groups, groups[::-1]):
        df = spark.createDataFrame(rows, "g int, x double").repartition(5)
        assert {r.g: r.s for r in df.groupBy("g").agg(fx.exact_sum("x").alias("s")).collect()} == want
        halves = df.withColumn("h", F.hash("x") % 2).groupBy("g", "h").agg(
            *[p.alias(n) for n, p in fx.sum_parts("x").items()])
        merged = halves.groupBy("g").agg(*[F.sum(n).alias(n) for n in fx.PARTS])
        assert {r.g: r.s for r in merged.select("g", fx.from_parts(
            {n: n for n in fx.PARTS}).alias("s")).collect()} == want


def test_nan_stays_in_sums_and_averages(spark):
    df = spark.createDataFrame([(float("nan"),), (4.0,)], "x double")
    r = df.agg(fx.exact_sum("x").alias("s"), fx.exact_avg("x").alias("a")).first()
    assert r.s != r.s and r.a != r.a


def test_to_int_rounds(spark):
    out = one(spark, [(1.5,), (2.5,), (2.4,), (-1.5,)], "x double", fx.to_int("x"))
    assert [r[0] for r in out] == [2, 3, 2, -2]


def test_guarded_ratio_never_divides_by_zero(spark):
    out = one(spark, [(1.0, 0.0), (1.0, None), (1.0, 4.0)], "a double, b double",
              fx.guarded_ratio("a", "b", 100))
    assert [r[0] for r in out] == [None, None, 25.0]


def test_period_label_peak_wins(spark):
    # ranks of 5 hours with distinct volumes 50,40,30,20,10
    rows = [(1, 5), (2, 4), (3, 3), (4, 2), (5, 1)]
    out = [r[0] for r in one(spark, rows, "peak int, trough int", fx.period_label("peak", "trough"))]
    assert out == ["Peak period"] * 3 + ["Trough period"] * 2
