"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from lakemart.plans import queries
from tests.conftest import SMALL_SF

TABLES = "region nation customer supplier part orders lineitem events".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMALL_SF, t + '.parquet')}')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["songplay_id", "start_time"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(queries.QUERIES) == set(queries.ORACLE)
    assert set(queries.QUERIES) <= set(entry.queries()) and set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SMALL_SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(rows, df.columns) == _bag(res.fetchall(), ocols)
