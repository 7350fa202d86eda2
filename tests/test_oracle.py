"""Every registered query against its SQL oracle (DuckDB) at sf0.01, plus the
rows-only checks of the model queries (bounds instead of values)."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from hourglass.plans.catalog import ORACLE, QUERIES
from hourglass.plans.lookalike import TABLES

SF = os.environ.get("HOURGLASS_TEST_SF", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables missing")


def _norm(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


SPARK_TO_DUCKDB = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                   "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    assert {c: SPARK_TO_DUCKDB.get(t, t) for c, t in df.dtypes} == \
        {c: str(t) for c, t in zip(rel.columns, rel.types)}
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_every_query_is_registered_once():
    qs, sql = QUERIES, ORACLE
    assert set(sql) <= set(qs) <= set(E.queries())
    rows_only = set(qs) - set(sql)
    assert rows_only == {"s7_save_model", "b1_bernoulli_sample", "b4_train_test_split", "m1_assemble",
                         "m3_fit_logistic", "m4_fit_multinomial", "m5_fit_naive_bayes",
                         "m6_fit_random_forest",
                         "m11_coefficients", "m12_score", "q4_train_crash_model", "q7_area_model"}


def test_model_queries_rows_and_bounds(spark):
    q4 = {r.metric: r.value for r in E.queries()["q4_train_crash_model"](spark, SF).collect()}
    assert q4["n_train"] > 0 and q4["n_test"] > 0
    assert 0.0 <= q4["auc_hard_test"] <= 1.0
    assert {"coef_intercept", "coef_temperature_norm", "coef_pedestrians_norm"} <= set(q4)
    q7 = E.queries()["q7_area_model"](spark, SF).collect()
    assert {r.model for r in q7} == {"area", "logistic", "multinomial", "naive_bayes"}
    assert all(0.0 <= r.value <= 1.0 for r in q7 if r.metric.startswith(("auc", "accuracy")))
    split = E.queries()["b4_train_test_split"](spark, SF).count()
    total = E.queries()["p3_count_rows"](spark, SF).first().n_rows
    assert 0.6 * total < split < 0.8 * total


def test_entry_smoke(spark):
    df = E.entry(spark)
    first = df.collect()
    assert len(first) > 0
    assert df.columns == ["weather", "factor", "weather_count", "weather_factor_count", "frac"]
    assert E.entry(spark).dtypes == df.dtypes


MODEL_QUERIES = ("m3_", "m4_", "m5_", "m6_", "m11_", "m12_", "q4_", "q7_", "s7_")


def test_query_outputs_have_unique_public_columns(spark):
    """The driver compares columns sorted by name: no duplicates, no internal helpers."""
    small = SF.replace("sf0.01", "sf0.001")
    for name, fn in QUERIES.items():
        if name.startswith(MODEL_QUERIES):
            continue
        cols = fn(spark, small).columns
        assert len(set(cols)) == len(cols), name
        assert not any(c.startswith("_") for c in cols), name
