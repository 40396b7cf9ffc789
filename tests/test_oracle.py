"""Every query with an oracle matches DuckDB exactly on the sf0.001 tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

TABLES = ["orders", "customer", "labels", "documents", "embeddings"]
SQL = E.oracle_sql()


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{os.path.join(SF001, t)}.parquet')")
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _rows(got, df.columns) == _rows(want, cols)
