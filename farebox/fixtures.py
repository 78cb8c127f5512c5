"""Trip-shaped inputs derived from the driver's star-schema tables.

The reference reads monthly trip Parquet files and a zone CSV that are not
shipped; the mapping below (FIXTURES.md, section B) turns ``lineitem`` x
``orders`` into trips and ``nation`` x ``region`` into zones. It is a plain
lazy DataFrame plan, so its work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.schemas import TRIP_FIELDS

TABLES = ["lineitem", "orders", "nation", "region", "events"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _secs_of_day() -> Column:
    # Fixed values of the mapping: pseudo-random second of the day.
    return (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729
            + F.col("l_partkey") * 31) % 86400


def _cents(x: Column) -> Column:
    return F.floor(x / 100)


def trips_from_star(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Trips with the 21 raw-table columns (typed as the load DDL).

    One trip per lineitem; the only shuffle is the lineitem-orders equi-join
    on the order key, which Catalyst plans as a sort-merge (or broadcast,
    when AQE sees a small side) join. Columns not used downstream are pruned
    away before the scan.
    """
    li = lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus")
    od = orders.select("o_orderkey", "o_orderdate")
    # Both sides are fact-sized at scale: a sort-merge join on the order key
    # (co-partitioned shuffle, spills instead of failing). The hint keeps the
    # same plan on small inputs too, which also spreads the per-row work of
    # a single-row-group file over all shuffle partitions.
    j = li.join(od.hint("merge"), li.l_orderkey == od.o_orderkey, "inner")

    secs = _secs_of_day()
    pickup = F.timestamp_add("SECOND", secs, F.col("o_orderdate"))
    drop_secs = secs + (F.col("l_partkey") * 37 + F.col("l_suppkey") * 11
                        + F.col("l_linenumber") * 101) % 7500 - 300
    price = F.col("l_extendedprice")
    tip_cents = _cents(price * F.col("l_discount") * 2)
    sign = F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7), -1).otherwise(1)

    cols = {
        "vendor_id": (1 + F.col("l_linenumber") % 2).cast("int"),
        "tpep_pickup_datetime": F.when(F.col("l_orderkey") % 997 == 0, F.lit(None)).otherwise(pickup),
        "tpep_dropoff_datetime": F.timestamp_add("SECOND", drop_secs, F.col("o_orderdate")),
        "passenger_count": (F.col("l_partkey") % 6).cast("int"),
        "trip_distance": F.when(F.col("l_quantity") == 50, F.lit(None)).otherwise((F.col("l_quantity") - 1) / 4),
        "ratecode_id": (1 + F.col("l_orderkey") % 6).cast("int"),
        "store_and_fwd_flag": F.when(F.col("l_linestatus") == "F", "Y").otherwise("N"),
        "pu_location_id": F.when(F.col("l_suppkey") % 30 == 29, F.lit(None)).otherwise((F.col("l_suppkey") % 30).cast("int")),
        "do_location_id": (F.col("l_partkey") % 30).cast("int"),
        "payment_type": F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3).cast("int"),
        "fare_amount": _cents(price).cast("double") / 100,
        "extra": (F.col("l_linenumber") % 3).cast("double") / 2,
        "mta_tax": F.lit(0.5).cast("double"),
        "tip_amount": tip_cents.cast("double") / 100,
        "tolls_amount": F.lit(0).cast("double"),
        "improvement_surcharge": F.lit(1).cast("double"),
        "total_amount": (sign * (_cents(price) + tip_cents)).cast("double") / 100,
        "congestion_surcharge": F.lit(2.5).cast("double"),
        "airport_fee": F.when(F.col("l_suppkey") % 7 == 0, F.lit(1.25)).otherwise(F.lit(0.0)).cast("double"),
        "source_file": F.concat(F.lit("trips_"), F.year("o_orderdate").cast("string"), F.lit(".parquet")),
        "loaded_at": F.timestamp_add("DAY", F.lit(2), F.col("o_orderdate")),
    }
    return j.select(*[expr.alias(name) for name, expr in cols.items()])


def zones_from_star(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Zone lookup rows: one per nation; ids 15 and 20 share a zone name."""
    n = nation.select("n_nationkey", "n_name", "n_regionkey")
    r = region.select("r_regionkey", "r_name")
    j = n.join(r, n.n_regionkey == r.r_regionkey, "inner")
    return j.select(
        F.col("n_nationkey").cast("int").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.when(F.col("n_nationkey") == 20, F.lit("NATION_15")).otherwise(F.col("n_name")).alias("zone"),
        F.concat(F.lit("SZ_"), (F.col("n_nationkey") % 4).cast("string")).alias("service_zone"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("loaded_at"),
    )


def star_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_star(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "orders"))


def star_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones_from_star(read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region"))


def to_file_layout(trips: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Trips as the public monthly trip files store them: source field names
    (``VendorID``, ``PULocationID``, ``Airport_fee`` ...), 64-bit ids and
    fractional ``passenger_count`` / ``RatecodeID``, as published files do.
    ``keep`` names further columns that stay."""
    fractional = {"passenger_count", "ratecode_id"}
    wide = {"vendor_id", "pu_location_id", "do_location_id", "payment_type"}
    out = []
    for name, _dtype, file_name in TRIP_FIELDS:
        c = F.col(name)
        if name in fractional:
            c = c.cast("double")
        elif name in wide:
            c = c.cast("bigint")
        out.append(c.alias(file_name))
    return trips.select(*out, *keep)
