"""Every registered query against its DuckDB twin on the sf0.001 tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from genolake.oracle import SQL
from genolake.registry import QUERIES

from .conftest import SF_SMALL

TABLES = ["lineitem", "part"]


def _norm(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(round(x, 9))
    return repr(x)


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL) <= set(E.queries()) & set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["chrom", "variants", "null_qual"] and df.count() > 0


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="test data not present")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    cur = con.execute(E.oracle_sql()[name])
    drows, dcols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(srows, scols) == _rows(drows, dcols)
