"""Corpus queries against their DuckDB twins."""

import duckdb
import pytest

from genolake.llm.queries import QUERIES
from genolake.llm.sql import SQL
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", ["op2_decontamination", "op6_jaccard_join"])
def test_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    cur = con.execute(SQL[name])
    names = [d[0] for d in cur.description]
    df = QUERIES[name](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(r) for r in df.select(*names).collect()) == sorted(cur.fetchall())
