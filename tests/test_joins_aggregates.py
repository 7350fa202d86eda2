"""K1-K4, A1-A7, T*, U* on inline rows and their invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourglass.operators import aggregate as A
from hourglass.operators import joins as K
from hourglass.operators import order as O
from hourglass.plans import analyses as Q

H = [dt.datetime(2020, 1, 1, h) for h in range(6)]


@pytest.fixture()
def pair(spark):
    # hour 0: two facts; hour 1: none; hour 2 twice in the context (duplicate hour);
    # a fact at hour 5 has no context hour; null hour on both sides.
    ctx = spark.createDataFrame(
        [(H[0], "rain"), (H[1], "fog"), (H[2], "snow"), (H[2], "snow2"), (None, "sleet")],
        "hour_begin timestamp_ntz, weather_summary string")
    facts = spark.createDataFrame(
        [(1, H[0], "A"), (2, H[0], "B"), (3, H[2], "A"), (4, H[5], "C"), (5, None, "D")],
        "fact_id long, fact_hour timestamp_ntz, factor string")
    return ctx, facts


def rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("broadcast", ["auto", True, False])
def test_context_left_facts_equals_plain_left_join(spark, pair, broadcast):
    ctx, facts = pair
    ours = K.context_left_facts(ctx, facts, "hour_begin", "fact_hour", broadcast=broadcast)
    plain = ctx.join(facts, ctx.hour_begin == facts.fact_hour, "left")
    cols = ["hour_begin", "weather_summary", "fact_id", "fact_hour", "factor"]
    assert rows(ours, cols) == rows(plain, cols)
    assert ours.count() == 6   # 2 + 1 (null-extended) + 2 (duplicate hour) + 1 (null hour)


def test_k1_equals_k3_plus_k4(spark, pair):
    ctx, facts = pair
    k1 = K.context_left_facts(ctx, facts, "hour_begin", "fact_hour").count()
    k3 = K.facts_inner_context(facts, ctx, "fact_hour", "hour_begin").count()
    k4 = K.anti_join(ctx, facts, "hour_begin", "fact_hour").count()
    assert (k1, k3, k4) == (6, 4, 2)


def test_facts_left_context_drop_null(spark, pair):
    ctx, facts = pair
    left = K.facts_left_context(facts, ctx, "fact_hour", "hour_begin")
    assert left.count() == 6
    kept = K.facts_left_context(facts, ctx, "fact_hour", "hour_begin", drop_null=["weather_summary"])
    assert sorted(r.fact_id for r in kept.collect()) == [1, 2, 3, 3]


def test_fits_broadcast_bounds(spark):
    df = spark.range(1000).select(F.col("id"), F.lit("x" * 100).alias("s"))
    assert K.fits_broadcast(df, max_bytes=1 << 20)
    assert not K.fits_broadcast(df, max_rows=999)
    assert not K.fits_broadcast(df, max_bytes=50_000)


def test_factor_share_null_factor_counts_in_total(spark):
    joined = spark.createDataFrame(
        [("rain", "A"), ("rain", "A"), ("rain", "B"), ("rain", None), ("fog", "A"), ("fog", "B")],
        "weather_summary string, factor string")
    out = {(r.weather, r.factor): (r.weather_count, r.weather_factor_count, r.frac)
           for r in A.factor_share_by_weather(joined).collect()}
    assert out[("rain", "A")] == (4, 2, 0.5)
    assert out[("rain", None)] == (4, 0, 0.0)
    assert out[("fog", "B")] == (2, 1, 0.5)
    sums = {}
    for (w, _), (_, _, frac) in out.items():
        sums[w] = sums.get(w, 0.0) + frac
    assert sums == {"rain": pytest.approx(0.75), "fog": pytest.approx(1.0)}


def test_casualties_sum_invariant(spark):
    joined = spark.createDataFrame(
        [("rain", "A", 1, 0), ("rain", "A", 2, 1), ("fog", "B", None, 1), ("fog", "B", 3, 0)],
        "weather_summary string, factor string, injured int, killed int")
    for r in A.casualties_by_weather_factor(joined).collect():
        if r.factor == "A":
            assert (r.injured, r.killed, r.casualties) == (3, 1, 4)
        else:   # a null injured drops that row from the casualties sum only
            assert (r.injured, r.killed, r.casualties) == (3, 1, 3)


def test_rates_and_counts(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (1, 1), (1, None)], "hour_group int, casualties int")
    out = {r.hour_group: (r.n_rows, r.n_event, r.rate)
           for r in A.event_rate_by_bucket(df, "hour_group", F.col("casualties") > 0).collect()}
    assert out == {0: (2, 1, 0.5), 1: (2, 1, 0.5)}
    assert A.count_where(df, F.col("casualties") > 0).first().n == 2


def test_order_and_sets(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 3.0), ("d", None)], "k string, v double")
    assert [r.k for r in O.sort_desc(df, "v", ["k"]).collect()] == ["b", "c", "a", "d"]
    assert [r.k for r in O.top_n(df, "v", 2, ["k"]).collect()] == ["b", "c"]
    assert [r.k for r in O.head(df, 1, ["k"]).collect()] == ["a"]
    u = O.union_all(df.select("k"), df.select("k"))
    assert u.count() == 8 and O.distinct(u).count() == 4
    shares = spark.createDataFrame([("w", "Unspecified", 0.5), ("w", "X", 0.3), ("v", "Y", 0.9)],
                                   "weather string, factor string, frac double")
    assert [r.factor for r in O.top_factors(shares, weather="w").collect()] == ["X"]


def test_hot_value_sort_spreads_over_partitions(spark):
    # One value holds a third of the rows; with the unique tie key it spans several
    # range partitions. Coalescing is off here so the 8 range partitions stay visible.
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                        .otherwise(F.format_string("v%05d", F.col("id"))).alias("value"))

        def hot_per_partition(out):
            return out.rdd.glom().map(lambda rows: sum(r.value == "hot" for r in rows)).collect()

        spread = hot_per_partition(O.sort_lines(df))
        assert sum(spread) == 10_000 and max(spread) < 10_000
        assert max(hot_per_partition(O.sort_lines(df, spread_ties=False))) == 10_000
        lines = [r.value for r in O.sort_lines(df).collect()]
        assert lines == sorted(lines)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_lookup_join_recode(spark):
    df = spark.createDataFrame([("sleet",), ("clear-day",), ("tornado",), (None,)], "w string")
    table = spark.createDataFrame([("sleet", 0), ("clear-day", 9)], "label string, code int")
    for bc in ("auto", False):
        out = {r.w: r.w_code for r in K.lookup(df, "w", table, "label", "code", default=-1, broadcast=bc).collect()}
        assert out == {"sleet": 0, "clear-day": 9, "tornado": -1, None: -1}


def test_empty_inputs(spark):
    from hourglass.operators import model as M
    from hourglass.operators import scale as S
    from hourglass.plans import analyses as Q
    ctx = spark.createDataFrame([], "hour_begin timestamp_ntz, weather_summary string")
    facts = spark.createDataFrame([], "fact_id long, fact_hour timestamp_ntz, factor string, injured int, killed int")
    assert K.fits_broadcast(ctx)
    assert K.context_left_facts(ctx, facts, "hour_begin", "fact_hour").count() == 0
    assert Q.factor_share(facts, ctx).count() == 0
    assert Q.factor_casualties(facts, ctx, broadcast=False).count() == 0
    assert S.min_max_scale(facts, ["injured"]).count() == 0
    assert M.chi_square(facts, ["injured"], "killed").count() == 0
    assert {r.r for r in M.correlation_matrix(facts, ["injured", "killed"]).collect()} == {None}


def test_anti_join_paths_agree(spark, pair):
    ctx, facts = pair
    want = sorted(((r.hour_begin, r.weather_summary) for r in
                   ctx.join(facts, ctx.hour_begin == facts.fact_hour, "left_anti").collect()), key=repr)
    for bc in ("auto", True, False):
        got = sorted(((r.hour_begin, r.weather_summary) for r in
                      K.anti_join(ctx, facts, "hour_begin", "fact_hour", broadcast=bc).collect()), key=repr)
        assert got == want and len(got) == 2


def test_factor_analyses_behave_alike_at_every_size(spark):
    facts = spark.createDataFrame([(i % 5, f"F{i % 3}", i % 4, 0) for i in range(50)],
                                  "fact_hour int, factor string, injured int, killed int")
    ctx = spark.createDataFrame([(h, "rain" if h % 2 else None, h, "x") for h in range(5)],
                                "hour_begin int, weather_summary string, injured int, factor string")
    for analysis in (Q.factor_share, Q.factor_casualties):
        a, b = (sorted(map(tuple, analysis(facts, ctx, broadcast=x).collect()), key=str) for x in (True, False))
        assert a == b and a


def test_context_left_facts_names_shared_columns(spark):
    facts = spark.createDataFrame([(1, 2)], "fact_hour int, zip_code int")
    ctx = spark.createDataFrame([(1, 2)], "hour_begin int, zip_code int")
    with pytest.raises(ValueError, match="zip_code"):
        K.context_left_facts(ctx, facts, "hour_begin", "fact_hour")
