"""Sinks: partitioned Parquet, full-refresh tables, layer materialisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farebox.session import checkpoint_dir


def write_partitioned(df: DataFrame, path: str, keys: list[str], dynamic: bool = True,
                      max_records_per_file: int | None = None) -> None:
    """Write Hive-style ``key=value`` directories, one shuffle by the keys.

    The shuffle uses the REBALANCE hint rather than a plain repartition: rows
    of one partition value still land together, but AQE splits a skewed
    value (one month holding a third of the rows) over several tasks of the
    advisory size and merges tiny ones, so no single task writes a hot month.
    ``dynamic`` replaces only the partitions present in ``df``.
    """
    df = df.hint("rebalance", *keys)
    writer = (df.write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic" if dynamic else "static"))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.partitionBy(*keys).parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """Full refresh: the table at ``path`` is replaced as a whole."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def materialize(spark: SparkSession, df: DataFrame, how: str, name: str,
                path: str | None = None) -> DataFrame:
    """Materialise a layer as a ``view`` (lazy, re-evaluated by every reader)
    or a ``table`` (written once to ``path`` and read back, which also cuts
    the lineage so a lost executor never recomputes the upstream layers)."""
    if how == "view":
        df.createOrReplaceTempView(name)
        return df
    if how == "table":
        if not path:
            raise ValueError("a table needs a path")
        write_table(df, path)
        out = spark.read.parquet(path)
        out.createOrReplaceTempView(name)
        return out
    raise ValueError(f"unknown materialisation {how!r}")


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the session's reliable checkpoint folder
    (``spark.checkpoint.dir``) and cut its lineage.

    Meant for small intermediate results read more than once (a mart that a
    report joins with its own aggregate): the upstream trip plan runs once,
    and a lost executor re-reads the checkpoint instead of recomputing it.
    """
    checkpoint_dir(df.sparkSession)
    # A fresh projection plans new exchanges, so a DataFrame object reused
    # across calls never silently reuses the shuffle files of an earlier run.
    return df.select("*").checkpoint(eager=True)
