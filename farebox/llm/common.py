"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from farebox.session import scratch_path

ARROW_ROWS = 1000
ARROW_BYTES = "16m"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: lineage is
    cut by files that every executor reaches."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_arrow_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Texts may be long: hand Python workers few rows and few bytes at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def per_worker(key: str, make: Callable):
    """What ``make`` gives, made once in the life of a Python worker."""
    held = sys.modules.setdefault("_farebox_worker", types.ModuleType("_farebox_worker"))
    if not hasattr(held, key):
        setattr(held, key, make())
    return getattr(held, key)


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each of n nodes' components under the edges a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        root = root[root]
        if np.array_equal(root, before):
            break
    return root


cloudpickle.register_pickle_by_value(sys.modules[__name__])
