"""Registered SQL of the training-data operators against their queries."""

import duckdb
import pytest
from hourglass.llm.queries import ORACLE, QUERIES
from hourglass.plans.lookalike import TABLES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    at = [df.columns.index(c) for c in cols]
    assert sorted((tuple(r[i] for i in at) for r in rows), key=str) == sorted(res.fetchall(), key=str)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
