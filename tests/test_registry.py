"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tableflow.plans.oracles import oracles
from tableflow.plans.queries import registry
from tableflow.plans.tables import TABLES
from tests.conftest import SF_SMALL

QUERIES = {name: E.queries()[name] for name in registry()}
ORACLES = oracles()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=lambda t: tuple(map(str, t)))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(E.oracle_sql())


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["price_band", "c_mktsegment", "n_orders", "least_total", "greatest_total", "n_customers"]
    assert 0 < df.count() <= 10


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    res = duck.execute(ORACLES[key])
    d_cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, df.collect()) == _rows(d_cols, res.fetchall())
