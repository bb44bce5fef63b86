"""Driver contract: entry smoke, and every registered query against its SQL oracle."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from obsmart.plans import catalog
from obsmart.plans.catalog import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "kind" in df.columns


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if v is not None and hasattr(v, "isoformat"):
        return (v.replace(tzinfo=None) if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) else v).isoformat()
    return repr(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_listed():
    assert set(catalog.queries()) - set(E.oracle_sql()) == set()
    assert set(catalog.queries()) <= set(E.queries())


# Spark type -> DuckDB type of the same values.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "string": "VARCHAR",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF)
    rel = con.sql(E.oracle_sql()[key])
    spark_types = {f.name: TYPES.get(f.dataType.simpleString()) for f in sdf.schema.fields}
    assert spark_types == dict(zip(rel.columns, [str(t) for t in rel.types]))
    res = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _digest(sdf.columns, [tuple(r) for r in sdf.collect()]) == _digest(dcols, res.fetchall())
