"""Sets of tables that are published all or nothing, and their names.

Each run writes its tables to folders of its own (``<layer>/<table>/run_id=...``).
A release becomes current by one appended row, in a file of its own, in the pointer
table ``releases``; until then readers see the release before it in full. Names in
the session's catalogue are set from the pointer and can be set again at any time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

POINTER = "releases"
_POINTER_FIELDS = "seq bigint, run_id string, tables array<struct<layer:string,name:string>>"


class Release:
    """The tables of one run below ``base``; nobody reads them before ``commit``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.run_id = uuid.uuid4().hex
        self.tables: list[tuple[str, str]] = []

    def write(self, df: DataFrame, layer: str, name: str) -> DataFrame:
        """Write a table of this run; the table as it is read back, which cuts the
        lineage."""
        path = table_path(self.base, layer, name, self.run_id)
        df.write.parquet(path)
        self.tables.append((layer, name))
        return self.spark.read.schema(df.schema).parquet(path)

    def commit(self) -> None:
        """Make this run the current release."""
        before = current(self.spark, self.base)
        row = (before.seq + 1 if before else 0, self.run_id, self.tables)
        (self.spark.createDataFrame([row], _POINTER_FIELDS).coalesce(1)
         .write.mode("append").parquet(f"{self.base}/{POINTER}"))


def table_path(base: str, layer: str, name: str, run_id: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{name}/run_id={run_id}"


def current(spark: SparkSession, base: str) -> Row | None:
    """(seq, run_id, tables) of the current release; None before the first."""
    try:
        rows = spark.read.schema(_POINTER_FIELDS).parquet(f"{base.rstrip('/')}/{POINTER}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = F.max(F.struct("seq", "run_id", "tables")).alias("r")
    return rows.agg(newest).first()["r"]


def read_table(spark: SparkSession, base: str, layer: str, name: str) -> DataFrame:
    """A table of the current release."""
    release = current(spark, base)
    if release is None or (layer, name) not in {(t.layer, t.name) for t in release.tables}:
        raise LookupError(f"no released table {layer}.{name} below {base}")
    return spark.read.parquet(table_path(base, layer, name, release.run_id))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register(spark: SparkSession, base: str,
             views: dict[tuple[str, str], tuple[tuple[str, str], list[str]]] | None = None) -> None:
    """Name the current release's tables ``layer.table`` in the catalogue, where all
    its sessions find them, and the views (layer, view) -> ((layer, table), columns)
    on them. A table of the same columns only changes its place; sessions that have
    read one with other columns refresh it."""
    base = base.rstrip("/")
    release = current(spark, base)
    if release is None:
        raise LookupError(f"nothing is released below {base}")
    layers = {t.layer for t in release.tables} | {layer for layer, _ in views or {}}
    for layer in sorted(layers):
        # a place of its own: the warehouse folder may be local to one machine
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}` LOCATION {_quoted(f'{base}/_names/{layer}')}")
    for t in release.tables:
        name, path = f"`{t.layer}`.`{t.name}`", table_path(base, t.layer, t.name, release.run_id)
        schema = spark.read.parquet(path).schema
        if spark.catalog.tableExists(f"{t.layer}.{t.name}"):
            if spark.table(name).schema == schema:
                spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(path)}")
                spark.catalog.refreshTable(name)
                continue
            spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {_quoted(path)}")
    for (layer, view), ((of_layer, table), columns) in (views or {}).items():
        spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{view}` AS SELECT "
                  + ", ".join(f"`{c}`" for c in columns) + f" FROM `{of_layer}`.`{table}`")
