"""P3-P13 on inline rows."""

import pytest

from hourglass.operators import order as O
from hourglass.operators import profile as P


@pytest.fixture()
def df(spark):
    return spark.createDataFrame(
        [("a", 1, "-1", 2.0), ("b", None, "x", 4.0), ("a", 3, "-1", None), (None, 3, "y", 6.0)],
        "k string, n int, s string, d double")


def test_counts(df):
    assert P.row_count(df).first().n_rows == 4
    assert tuple(P.null_counts(df).first()) == (1, 1, 0, 1)
    assert tuple(P.null_counts(df, ["n"]).first()) == (1,)
    assert tuple(P.sentinel_counts(df, ["s"]).first()) == (2,)
    assert P.count_distinct(df, ["k", "n"]).first().asDict() == {"k": 2, "n": 2}
    assert P.count_distinct(df, ["k", "n"], approx=True).first().asDict() == {"k": 2, "n": 2}


def test_value_counts_orders(df):
    by_count = [tuple(r) for r in P.value_counts(df, "k").collect()]
    assert by_count == [("a", 2), (None, 1), ("b", 1)]
    by_value = [tuple(r) for r in P.value_counts(df, "n", sort="value").collect()]
    assert by_value == [(3, 2), (1, 1), (None, 1)]
    assert [tuple(r) for r in P.class_balance(df, "s").collect()][0] == ("-1", 2)


def test_min_max_and_describe(df):
    row = P.min_max(df, ["n", "d"]).first()
    assert (row.min_n, row.max_n, row.min_d, row.max_d) == (1, 3, 2.0, 6.0)
    desc = {r.column: r for r in P.describe(df, ["n", "d"]).collect()}
    assert desc["d"]["count"] == 3 and desc["d"].mean == pytest.approx(4.0)
    assert desc["d"].stddev == pytest.approx(2.0)
    assert (desc["n"].min, desc["n"].max) == (1.0, 3.0)


def test_distinct_values_and_schema(df):
    assert sorted(r.s for r in P.distinct_values(df, "s").collect()) == ["-1", "x", "y"]
    assert P.schema_report(df) == [(0, "k", "string"), (1, "n", "int"), (2, "s", "string"), (3, "d", "double")]


def test_union_widens_types(spark):
    a = spark.createDataFrame([(1,)], "v int")
    b = spark.createDataFrame([(2**40,)], "v bigint")
    u = O.union_all(a, b)
    assert u.dtypes == [("v", "bigint")] and sorted(r.v for r in u.collect()) == [1, 2**40]
    assert [r.v for r in O.sort_lines(spark.createDataFrame([("b",), ("B",), ("a",)], "v string"), "v")
            .collect()] == ["B", "a", "b"]
