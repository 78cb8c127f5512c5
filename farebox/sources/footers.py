"""A catalogue of Parquet files, read from their footers by Spark tasks.

Spark lists the files (any store, any glob); tasks open the footer of each, a few
kilobytes at its end, and emit one row per field. What files hold, lack or type
differently are then ordinary queries on this table: one job, however many
layouts there are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import quote, urlparse

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOGUE = "file string, field string, type string, row_count bigint"
#: Stores that a task can open by itself; footers of others are cut from whole
#: files that Spark reads.
DIRECT = {"file", "hdfs", "s3", "s3a", "gs", "gcs", "abfs", "abfss"}
#: Names that Spark writes into footers and those of its SQL.
_SQL_NAMES = {"byte": "tinyint", "short": "smallint", "integer": "int", "long": "bigint"}
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def type_name(t: pa.DataType) -> str:
    """Spark's name of a field type; nested and other types as they are written."""
    plain = {pa.int8(): "tinyint", pa.int16(): "smallint", pa.int32(): "int", pa.int64(): "bigint",
             pa.uint8(): "smallint", pa.uint16(): "int", pa.uint32(): "bigint",
             pa.uint64(): "decimal(20,0)", pa.float32(): "float", pa.float64(): "double",
             pa.bool_(): "boolean", pa.date32(): "date", pa.string(): "string",
             pa.large_string(): "string", pa.binary(): "binary", pa.large_binary(): "binary"}
    if t in plain:
        return plain[t]
    if pa.types.is_timestamp(t):
        return "timestamp" if t.tz else "timestamp_ntz"
    if pa.types.is_decimal(t):
        return f"decimal({t.precision},{t.scale})"
    if pa.types.is_dictionary(t):
        return type_name(t.value_type)
    return str(t)


def fields_of(meta: pq.FileMetaData) -> list[tuple[str, str]]:
    """(field, type) of a footer; files written by Spark name their types there."""
    own = (meta.metadata or {}).get(_SPARK_SCHEMA)
    if own:
        kinds = {f["name"]: f["type"] if isinstance(f["type"], str) else f["type"]["type"]
                 for f in json.loads(own)["fields"]}
        return [(name, _SQL_NAMES.get(kind, kind)) for name, kind in kinds.items()]
    schema = meta.schema.to_arrow_schema()
    found = {c.path: c.physical_type for c in map(meta.schema.column, range(meta.num_columns))}
    return [(f.name, "timestamp" if found.get(f.name) == "INT96" else type_name(f.type))
            for f in schema]


def _footer(path: str, content: bytes | None) -> pq.FileMetaData:
    if content is not None:
        return pq.read_metadata(pa.BufferReader(content))
    from pyarrow import fs

    scheme, rest = path.split(":", 1)
    store, inside = fs.FileSystem.from_uri({"s3a": "s3"}.get(scheme, scheme) + ":" + quote(rest))
    return pq.read_metadata(inside, filesystem=store)


def footers(spark: SparkSession, path: str | list[str], whole: bool | None = None) -> DataFrame:
    """(file, field, type, row_count): a row for every field of every Parquet file
    of a path, a glob or a list of them; a file without fields has one row with a
    null field.

    ``whole`` reads files through Spark instead of opening their footers, for
    stores that tasks can't open; by default it is decided by the listed paths."""
    paths = [path] if isinstance(path, str) else list(path)
    listed = spark.read.format("binaryFile").load(paths)
    if whole is None:
        first = listed.select("path").first()
        whole = first is not None and urlparse(first["path"]).scheme not in DIRECT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            contents = b.column(1).to_pylist() if b.num_columns > 1 else [None] * len(b)
            rows = []
            for name, content in zip(b.column(0).to_pylist(), contents, strict=True):
                meta = _footer(name, content)
                rows += [(name, f, t, meta.num_rows) for f, t in fields_of(meta) or [(None, None)]]
            if rows:
                files, fields, types, counts = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(files), pa.array(fields, pa.string()), pa.array(types, pa.string()),
                     pa.array(counts, pa.int64())], names=["file", "field", "type", "row_count"])

    return listed.select("path", *["content"] * bool(whole)).mapInArrow(run, CATALOGUE)


def lacking(catalogue: DataFrame, required: list[str]) -> DataFrame:
    """(file, fields): files without some required field, compared without regard
    to case, and which."""
    wanted = F.array(*[F.lit(f.lower()) for f in required])
    held = F.collect_set(F.lower("field"))
    return (catalogue.groupBy("file").agg(F.array_except(wanted, held).alias("fields"))
            .where(F.size("fields") > 0))


def layouts(catalogue: DataFrame, fields: list[str], required: list[str] = ()) -> DataFrame:
    """(layout, files, lacks): sets of files that hold the same of the given fields
    with the same types, and the required fields that they lack. ``layout`` is an
    array of (field, type), by name in lower case."""
    wanted = F.array(*[F.lit(f.lower()) for f in fields])
    needed = F.array(*[F.lit(f.lower()) for f in required]).cast("array<string>")
    name = F.lower("field")
    pairs = F.collect_set(F.when(F.array_contains(wanted, name), F.struct(
        name.alias("field"), F.col("type"))))
    per_file = catalogue.groupBy("file").agg(
        F.array_sort(pairs).alias("layout"), F.collect_set(name).alias("held"))
    return (per_file.select("file", "layout", F.array_except(needed, "held").alias("lacks"))
            .groupBy("layout", "lacks").agg(F.array_sort(F.collect_list("file")).alias("files")))
