"""Stages laid out for reuse, lines numbered over files, ranks per group, stored sums, large mappings."""

import pytest
from pyspark.sql import functions as F

from hourglass.operators import aggregate as A
from hourglass.operators import joins as K
from hourglass.operators import order as O
from hourglass.session import scratch_path
from hourglass.sources import io


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("salt", [1, 4])
def test_bucketed_join_has_no_exchange(spark, salt):
    facts = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("f"))
    ctx = spark.range(40).select(F.col("id").alias("c"), (F.col("id") * 2).alias("w"))
    pair = K.bucketed_pair(facts, ctx, "k", "c", 4, salt)
    out = K.join_buckets(*pair, "k", "c")
    assert "SortMergeJoin" in plan(out) and "Exchange" not in plan(out)
    want = facts.join(ctx, facts.k == ctx.c)
    assert out.columns == want.columns
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))


def test_lines_numbered_over_files(spark):
    path = scratch_path(spark, "numbered")
    lines = [f"line {i} " + "é" * (i % 5) for i in range(500)]
    df = spark.createDataFrame(list(enumerate(lines)), "n int, value string")
    df.repartitionByRange(7, "n").sortWithinPartitions("n").select("value").write.text(path)
    got = sorted(map(tuple, io.number_lines(spark, path).collect()))
    at, want = 0, []
    for i, line in enumerate(lines):
        want.append((at, i, line))
        at += len(line.encode()) + 1
    assert got == want
    assert io.number_lines(spark, path).selectExpr("count(DISTINCT line_no)").first()[0] == 500


def test_top_per_group(spark):
    rows = [("a", i % 17, i) for i in range(200)] + [("b", 1, 500), (None, 3, 600), (None, 4, 601), ("a", None, 900)]
    df = spark.createDataFrame(rows, "g string, v int, id int")
    want = {}
    for g in ("a", "b", None):
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        want[g] = [r[2] for r in mine[:3]]
    for salt in (0, 4):
        got = {}
        for r in sorted(O.top_per_group(df, "g", "v", 3, ("id",), salt=salt).collect(), key=lambda r: r["rank"]):
            got.setdefault(r.g, []).append(r.id)
        assert got == want
    out = O.top_per_group(df, "g", "v", 3, ("id",))
    assert "WindowGroupLimit" in plan(out)


def test_stored_sums_equal_all_at_once(spark):
    rows = [("rain" if i % 3 else "clear", None if i % 11 == 0 else f"F{i % 4}", i % 5, None if i % 7 == 0 else i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "weather_summary string, factor string, injured int, killed int")
    root = scratch_path(spark, "sums")
    rows = df.withColumn("n", F.monotonically_increasing_id())
    for batch in range(3):
        state = A.update_partials(spark, root, batch, rows.filter(F.col("n") % 3 == batch))
    state = A.update_partials(spark, root, 2, rows.filter(F.col("n") % 3 == 2))  # run again: the same version
    key = lambda r: tuple(map(str, r))
    for mine, whole in ((A.shares_of_partials(state), A.factor_share_by_weather(df)),
                        (A.casualties_of_partials(state), A.casualties_by_weather_factor(df))):
        assert sorted(mine.select(whole.columns).collect(), key=key) == sorted(whole.collect(), key=key)


@pytest.mark.parametrize("how", [{}, {"max_broadcast_bytes": 10}, {"max_broadcast_bytes": 10, "salt": 3}])
def test_lookup_on_every_path(spark, how):
    df = spark.createDataFrame([(i, [None, 7, 7, 8, 99][i % 5]) for i in range(50)], "id int, k int")
    table = spark.createDataFrame([(7, 70), (8, 80)], "key int, v int")
    got = {r.id: r.k_code for r in K.lookup(df, "k", table, "key", "v", default=-1, **how).collect()}
    assert got == {i: {0: -1, 1: 70, 2: 70, 3: 80, 4: -1}[i % 5] for i in range(50)}
