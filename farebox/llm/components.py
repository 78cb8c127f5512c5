"""Connected components of an edge table, by Spark jobs only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import stored

HOT_NODES = 512           # a node with more than this part of all edges is joined apart


def _print(edges: DataFrame) -> tuple:
    """Count and two sums of hashes: equal for equal edge sets."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(h),
                           F.sum(h.cast("decimal(38,0)"))).first())


def join_keyed(rows: DataFrame, keyed: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Rows joined with a table of one row per key, whose ``weight`` is the number of
    rows of the key; ``total`` is the number of all rows. Keys with more than a
    HOT_NODES-th of all rows, of which there are at most HOT_NODES, meet their rows
    where these lie; only the others are dealt out by key."""
    hot = F.col(weight) > total / HOT_NODES
    near = rows.join(F.broadcast(keyed.where(hot)), key)
    names = F.broadcast(keyed.where(hot).select(key))
    return near.unionByName(rows.join(names, key, "left_anti").join(keyed.where(~hot), key))


def with_lowest(edges: DataFrame, key: str, value: str, total: int) -> tuple[DataFrame, DataFrame]:
    """(edges with ``low``, the least value of their key; the (key, low) pairs), of a
    stored table of at most ``total`` edges."""
    low = edges.groupBy(key).agg(F.min(value).alias("low"), F.count(F.lit(1)).alias("edges"))
    return join_keyed(edges, low, key, "edges", total).drop("edges"), low.select(key, "low")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest id reachable from each id on an edge.

    Large-star and small-star by turns, each a grouping with a minimum, until
    the edges stay the same; each half round is stored. An id with very many edges
    costs the grouping one row per task, and its edges are re-linked where they
    lie, not gathered."""
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where("u <> v").distinct())
    e = stored(e, "cc")
    before = _print(e)
    while True:
        # large star: every larger neighbour is linked to the smallest one
        total = 2 * before[0]
        both = e.select("u", "v").union(e.select(F.col("v"), F.col("u"))).toDF("n", "m")
        starred, _ = with_lowest(both, "n", "m", total)
        large = stored(starred.where("m > n").select(
            F.col("m").alias("u"), F.least("low", "n").alias("v")).distinct(), "cc-large")
        # small star: every smaller neighbour is linked to the smallest one
        starred, least = with_lowest(large, "u", "v", total)
        small = (starred.select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .union(least).where("u <> v").distinct())
        now = stored(small, "cc")
        after = _print(now)
        if after == before:
            break
        e, before = now, after
    # stars only: every node links to its component
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select("v", "v")).distinct()
