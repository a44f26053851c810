"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

import datetime as dt
import decimal
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from cohortwise.plans.oracle import oracle_queries
from cohortwise.plans.queries import QUERIES
from cohortwise.sources.tables import RAW_TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.9g}"
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def table(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), Counter(tuple(canon(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in RAW_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_queries())
    assert QUERIES.keys() <= entry.queries().keys()
    assert oracle_queries().items() <= entry.oracle_sql().items()
    assert len(QUERIES) == 61


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    s_cols, s_rows = table(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(oracle_queries()[name])
    o_cols, o_rows = table([x[0] for x in res.description], res.fetchall())
    assert s_cols == o_cols
    assert s_rows == o_rows


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 87
    df.collect()
