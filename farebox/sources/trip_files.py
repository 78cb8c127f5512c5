"""Typed loading of trip files and the load-time columns."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.schemas import REQUIRED_FIELDS, TRIP_FIELDS
from farebox.session import scratch_path
from farebox.sources.footers import footers, layouts

_FRACTIONAL = (T.DoubleType, T.FloatType, T.DecimalType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


_EPOCH = "1970-01-01 00:00:00"
_MICROS = 1_000_000


class TripFileError(ValueError):
    """Trip files that can't be loaded as they are."""


def epoch_micros_to_ts(c) -> Column:
    """Epoch microseconds (a number) -> un-zoned timestamp, whatever the session's
    time zone."""
    col = c if isinstance(c, Column) else F.col(c)
    seconds = (col.cast("bigint").cast("decimal(20,0)") / _MICROS).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit(_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def ts_to_epoch_micros(c) -> Column:
    """Un-zoned timestamp -> epoch microseconds, whatever the session's time zone."""
    col = (c if isinstance(c, Column) else F.col(c)).cast("timestamp_ntz")
    whole = F.unix_date(F.to_date(col)).cast("bigint") * 86400 + F.hour(col) * 3600 + F.minute(col) * 60
    return whole * _MICROS + (F.extract(F.lit("SECOND"), col) * _MICROS).cast("bigint")


def cast_field(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast a file column to the table type; NULL where that can't be done.

    Fractional -> integer rounds half-up (a truncating cast would turn 2.7
    passengers into 2); a number -> timestamp is read as epoch microseconds.
    """
    if isinstance(target, T.IntegerType) and isinstance(source, _FRACTIONAL):
        return F.round(c).try_cast(target)
    if isinstance(target, T.TimestampNTZType) and isinstance(source, _INTEGRAL + _FRACTIONAL):
        return epoch_micros_to_ts(c.try_cast("bigint"))
    if type(source) is type(target):
        return c
    return c.try_cast(target)


def checked_cast(c: Column, source: T.DataType, target: T.DataType, field: str,
                 source_file: Column) -> Column:
    """``cast_field``, but a value that can't be cast is an error, whether or not
    the session is in ANSI mode."""
    out = cast_field(c, source, target)
    if type(source) is type(target):
        return out
    bad = F.raise_error(F.concat(F.lit(f"{field} of trip file "), F.coalesce(source_file, F.lit("?")),
                                 F.lit(" can't be loaded: "), c.cast("string")))
    return F.when(c.isNotNull() & out.isNull(), bad.cast(target)).otherwise(out)


def stamp_loaded_at(df: DataFrame, as_of: dt.datetime | str | None = None) -> DataFrame:
    """Append ``loaded_at``: the given instant, or the current time.

    An explicit ``as_of`` keeps reruns deterministic."""
    if as_of is None:
        ts = F.current_timestamp().cast("timestamp_ntz")
    else:
        ts = F.lit(str(as_of)).cast("timestamp_ntz")
    return df.withColumn("loaded_at", ts)


def typed_trips(files: DataFrame, source_file: Column | None = None) -> DataFrame:
    """Pick the 19 trip fields by name (case-insensitively, so ``Airport_fee``
    and ``airport_fee`` both load), cast each to the table type, rename to
    snake_case and append the file name. A field absent from the files loads
    as NULL."""
    by_lower = {f.name.lower(): f for f in files.schema.fields}
    if source_file is None:
        source_file = F.col("_metadata.file_name")
    cols = []
    for name, dtype, file_name in TRIP_FIELDS:
        field = by_lower.get(file_name.lower())
        if field is None:
            cols.append(F.lit(None).cast(dtype).alias(name))
        else:
            cols.append(checked_cast(F.col(f"`{field.name}`"), field.dataType, dtype, file_name,
                                     source_file).alias(name))
    cols.append(source_file.alias("source_file"))
    return files.select(*cols)


def trip_layouts(spark: SparkSession, path: str | list[str],
                 required: list[str] = ()) -> list[DataFrame]:
    """The trip files of a path, a glob or a list of them, one DataFrame of their
    trip fields for each set of files whose field types agree; mostly that is one.

    One job over the files' footers finds the sets, however many layouts there are.
    A file that lacks a required field is an error that names it. File names reach
    the driver only as the paths that the readers are given."""
    paths = [path] if isinstance(path, str) else list(path)
    names = {f.lower(): f for _, _, f in TRIP_FIELDS}
    rows = layouts(footers(spark, paths), list(names.values()), list(required)).collect()
    if not rows:
        raise TripFileError(f"no trip files: {', '.join(paths)}")
    bad = sorted((f, r["lacks"]) for r in rows if r["lacks"] for f in r["files"])
    if bad:
        raise TripFileError("trip files without needed fields: " + "; ".join(
            f"{f} lacks {', '.join(names.get(x, x) for x in lacks)}" for f, lacks in bad))
    sets: list[tuple[dict, list[str]]] = []
    for r in sorted(rows, key=lambda r: r["files"][0]):
        types = {f["field"]: f["type"] for f in r["layout"]}
        for held, members in sets:
            if all(held.get(f, t) == t for f, t in types.items()):
                held.update(types)
                members.extend(r["files"])
                break
        else:
            sets.append((types, list(r["files"])))
    return [spark.read.schema(", ".join(f"`{names[f]}` {t}" for f, t in types.items()))
            .parquet(*(paths if len(sets) == 1 else files)) for types, files in sets]


def scan_trips(spark: SparkSession, path: str | list[str], strict: bool = False,
               source_file: Column | None = None) -> DataFrame:
    """The raw trips' fields from trip files, lazily: a bad value is an error only
    of a query that uses it. See ``load_trips``."""
    found = trip_layouts(spark, path, REQUIRED_FIELDS if strict else ())
    return reduce(DataFrame.unionByName, [typed_trips(df, source_file) for df in found])


def load_trips(spark: SparkSession, path: str | list[str],
               as_of: dt.datetime | str | None = None, strict: bool = False,
               source_file: Column | None = None, folder: str | None = None) -> DataFrame:
    """Raw trips table from trip files (a path, a glob such as
    ``.../yellow_tripdata_2023-*.parquet``, or a list of them), all or nothing.

    One job casts every field of every file to the table type and writes the rows
    to ``folder`` (a new one of the shared scratch folder, unless given); the table
    is read from there. So one value that can't be cast fails the load, whatever is
    asked of the table later. Files may differ in their fields and in the types of
    them. A field that a file lacks is NULL for its rows; with ``strict`` a file
    without a required field is an error that names it."""
    trips = stamp_loaded_at(scan_trips(spark, path, strict, source_file), as_of)
    folder = folder or scratch_path(spark, "loaded-trips")
    trips.write.parquet(folder)
    return spark.read.schema(trips.schema).parquet(folder)
