"""Lookup joins of a fact table to a dimension.

No side is forced: the engine broadcasts a dimension whose size it knows to be
below its own byte threshold, and shuffles both sides otherwise. Beyond the
threshold a hot or NULL key would gather in one task; the salted join spreads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1 / 64        # a key with more of the facts than this is spread
SALTS_PER_PARTITION = 8   # parts of a hot key per shuffle partition


def hot_keys(facts: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold more than ``share`` of the facts, by a count that tasks add up
    before it is shuffled. There are at most 1 / ``share`` of them."""
    least = facts.count() * share
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return [r[key] for r in counts.where(F.col("n") > least).select(key).collect()]


def lookup_join(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                columns: dict[str, str], how: str = "left",
                hot: list | None = None, salts: int | None = None) -> DataFrame:
    """Join ``facts`` to ``dim`` on ``fact_key = dim_key`` and append
    ``columns`` (dimension column -> output name).

    LEFT by default: facts without a match, or with a NULL key, are kept with
    NULL dimension columns; a key present several times in ``dim`` fans out.
    The dimension side keeps its own column names and is renamed only after
    the join, so lookups of one dimension in several roles (pickup, drop-off)
    build the same dimension plan.

    With ``hot`` (see ``hot_keys``; may be empty) facts with such a key or none are
    dealt over ``salts`` parts by their content, and the dimension rows of the hot
    keys are repeated for each; NULL keys match none wherever they are.
    """
    d = dim.select(F.col(dim_key).alias("__lookup_key"), *columns.keys())
    name = f"__lookup_{fact_key}"
    key = facts[fact_key]
    if hot is None:
        r = d.alias(name)
        on = key == F.col(f"{name}.__lookup_key")
    else:
        salts = salts or SALTS_PER_PARTITION * int(
            facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        part = F.pmod(F.xxhash64(*[facts[c] for c in facts.columns]), F.lit(salts)).cast("int")
        zero = F.lit(0)
        dealt = F.when(key.isNull() | key.isin(hot), part).otherwise(zero)
        parts = F.when(F.col("__lookup_key").isin(hot), F.sequence(zero, F.lit(salts - 1)))
        r = d.withColumn("__salt", F.explode(parts.otherwise(F.array(zero)))).alias(name)
        on = (key == F.col(f"{name}.__lookup_key")) & (dealt == F.col(f"{name}.__salt"))
    joined = facts.join(r, on, how)
    return joined.select(*[facts[c] for c in facts.columns],
                         *[F.col(f"{name}.{src}").alias(dst) for src, dst in columns.items()])
