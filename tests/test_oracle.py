"""Every catalogue query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison on sf0.01): row count, column names and types, and
the exact multiset of rows."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from farebox.plans.catalog import QUERIES as CATALOGUE

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
SPARK_TO_DUCK = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE",
                 "StringType": "VARCHAR", "DateType": "DATE", "TimestampNTZType": "TIMESTAMP",
                 "BooleanType": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, list):
        return tuple(v)
    return v


def _rows(records, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_sql_or_is_rows_only():
    # of the catalogue; the text operators' keys are held in their own folder
    rows_only = set(CATALOGUE) - set(E.oracle_sql())
    assert set(CATALOGUE) <= set(E.queries())
    assert rows_only == {"dq_file_manifest"}
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF001)
    srows = [r.asDict() for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == sorted(df.columns)
    stypes = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__) for f in df.schema.fields}
    assert {c: str(d[1]) for c, d in zip(dcols, res.description)} == stypes
    drows = [dict(zip(dcols, r)) for r in res.fetchall()]
    cols = sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(srows, cols) == _rows(drows, cols)


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.count() == 794
    assert df.columns[-1] == "annual_revenue_rank"
