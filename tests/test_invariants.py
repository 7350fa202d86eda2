"""Invariants of the analyses on the sf0.01 look-alike tables and under a hot key."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from hourglass.operators import joins as K
from hourglass.operators import sample as B
from hourglass.plans import analyses as Q
from hourglass.plans import lookalike as V

SF = os.environ.get("HOURGLASS_TEST_SF", "/root/testdata/sf0.01")
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables missing")


@needs_data
def test_factor_share_invariants(spark):
    facts, ctx = V.facts_h(spark, SF), V.ctx_h(spark, SF)
    shares = Q.factor_share(facts, ctx).collect()
    per_weather = {}
    for r in shares:
        per_weather.setdefault(r.weather, []).append(r)
    for rows in per_weather.values():
        assert sum(r.frac for r in rows) == pytest.approx(1.0)
        assert sum(r.weather_factor_count for r in rows) == rows[0].weather_count
    joined = Q.crashes_with_weather(facts, ctx).count()
    assert sum(rows[0].weather_count for rows in per_weather.values()) == joined
    casualties = Q.factor_casualties(facts, ctx).collect()
    assert {(r.weather, r.factor) for r in casualties} == {(r.weather, r.factor) for r in shares}
    assert all(r.casualties == r.injured + r.killed for r in casualties)


@needs_data
def test_join_sizes_add_up(spark):
    facts, ctx = V.facts_h(spark, SF), V.ctx_h(spark, SF)
    k1 = K.context_left_facts(ctx, facts, "hour_begin", "fact_hour").count()
    k3 = K.facts_inner_context(facts, ctx, "fact_hour", "hour_begin").count()
    k4 = K.anti_join(ctx, facts, "hour_begin", "fact_hour").count()
    assert k1 == k3 + k4 and k4 > 0


@needs_data
def test_training_table_ranges_and_balance(spark):
    t = Q.training_table(V.ctx_h(spark, SF), V.facts_h(spark, SF))
    cols = ["temperature_norm", "precipitation_norm", "weather_norm", "day_norm", "hour_norm", "pedestrians_norm"]
    row = t.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    for c in cols:
        assert 0.0 <= row[f"lo_{c}"] <= row[f"hi_{c}"] <= 1.0
    weathered = V.ctx_h(spark, SF).filter("weather_summary IS NOT NULL")
    unmatched = K.anti_join(weathered, V.facts_h(spark, SF), "hour_begin", "fact_hour").count()
    assert t.filter("has_accident = 0").count() == unmatched


@needs_data
def test_hash_sample_same_rows_on_any_layout(spark):
    facts = V.facts_d(spark, SF).select("fact_id")
    a = B.hash_sample(facts.repartition(2), "fact_id", 0.3, 123)
    b = B.hash_sample(facts.repartition(16), "fact_id", 0.3, 123)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hot_key_gives_same_result_on_every_path(spark):
    """One hour holds a third of all facts; broadcast and shuffle paths agree with a plain join."""
    hot = dt.datetime(2024, 1, 1, 5)
    hours = [dt.datetime(2024, 1, 1, h) for h in range(24)]
    facts = spark.range(30_000).select(
        F.col("id").alias("fact_id"),
        F.when(F.col("id") % 3 == 0, F.lit(hot))
         .otherwise(F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1) + (F.col("id") % 40) / 24,
                                         (F.col("id") % 24).cast("int"), F.lit(0), F.lit(0))).alias("fact_hour"),
        F.concat(F.lit("F"), (F.col("id") % 5).cast("string")).alias("factor"),
        (F.col("id") % 4).cast("int").alias("injured"), (F.col("id") % 2).cast("int").alias("killed"))
    ctx = spark.createDataFrame([(h, "rain" if h.hour % 2 else "fog") for h in hours] + [(hours[3], None)],
                                "hour_begin timestamp_ntz, weather_summary string")
    plain_k1 = ctx.join(facts, ctx.hour_begin == facts.fact_hour, "left").count()
    for bc in (True, False):
        assert K.context_left_facts(ctx, facts, "hour_begin", "fact_hour", broadcast=bc).count() == plain_k1
    expected = sorted(tuple(r) for r in Q.factor_share(facts, ctx, broadcast=True).collect())
    assert sorted(tuple(r) for r in Q.factor_share(facts, ctx, broadcast=False).collect()) == expected
    c_true = sorted(tuple(r) for r in Q.factor_casualties(facts, ctx, broadcast=True).collect())
    assert sorted(tuple(r) for r in Q.factor_casualties(facts, ctx, broadcast=False).collect()) == c_true
    assert sum(r[2] for r in c_true) == facts.join(ctx.dropna(), facts.fact_hour == ctx.hour_begin) \
        .agg(F.sum("injured")).first()[0]


@needs_data
def test_readme_flow_from_files(spark):
    """The usage in the README: raw text and CSV files in, shares and a model out."""
    from hourglass.operators import clean
    from hourglass.session import scratch_path
    from hourglass.sources import io
    lines_path = scratch_path(spark, "raw-lines")
    V.crash_lines(spark, SF).select("value").write.text(lines_path)
    ctx_path = scratch_path(spark, "raw-ctx")
    raw_ctx = V.ctx_raw(spark, SF).drop("ctx_key")
    io.write_csv(raw_ctx, ctx_path)
    lines = io.read_lines(spark, lines_path)
    facts = Q.prepare_facts(clean.crash_table(lines), "BROOKLYN", "1997-01-01", "1999-12-31")
    ctx = Q.prepare_context(io.read_csv_strings(spark, ctx_path, raw_ctx.columns))
    assert facts.count() > 0 and ctx.count() > 0
    shares = Q.factor_share(facts, ctx)
    assert shares.columns == ["weather", "factor", "weather_count", "weather_factor_count", "frac"]
    shares.collect()
    training = Q.training_table(V.ctx_h(spark, SF), V.facts_h(spark, SF))
    model, metrics = Q.train_crash_model(training, max_iter=20, model_path=scratch_path(spark, "lr"))
    assert model.numFeatures == 6 and dict((m, v) for _, m, v in metrics)["n_train"] > 0


def test_salted_joins_equal_plain_joins(spark):
    """Salting the no-broadcast path changes where rows go, not which rows come out."""
    hot = dt.datetime(2024, 1, 1, 5)
    facts = spark.range(6_000).select(
        F.col("id").alias("fact_id"),
        F.when(F.col("id") % 3 == 0, F.lit(hot)).when(F.col("id") % 11 == 0, F.lit(None))
         .otherwise(F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), (F.col("id") % 24).cast("int"),
                                         F.lit(0), F.lit(0))).alias("fact_hour"),
        F.lit("F").alias("factor"))
    ctx = spark.createDataFrame([(dt.datetime(2024, 1, 1, h), "w") for h in range(0, 24, 2)]
                                + [(hot, "dup"), (None, "null-hour")],
                                "hour_begin timestamp_ntz, weather_summary string")

    def rows(df, cols):
        return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)

    cols_k = ["fact_id", "hour_begin", "weather_summary"]
    for salt in (1, 4):
        k1 = K.context_left_facts(ctx, facts, "hour_begin", "fact_hour", broadcast=False, salt=salt)
        assert rows(k1, cols_k) == rows(ctx.join(facts, ctx.hour_begin == facts.fact_hour, "left"), cols_k)
        k2 = K.facts_left_context(facts, ctx, "fact_hour", "hour_begin", broadcast=False, salt=salt)
        assert rows(k2, cols_k) == rows(facts.join(ctx, facts.fact_hour == ctx.hour_begin, "left"), cols_k)
        k3 = K.facts_inner_context(facts, ctx, "fact_hour", "hour_begin", broadcast=False, salt=salt)
        assert k3.count() == facts.join(ctx, facts.fact_hour == ctx.hour_begin).count()


@needs_data
def test_both_classes_at_every_scale(spark):
    """Hours without crash, crashes without context and two classes exist at every table size."""
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        d = SF.replace("sf0.01", sf)
        facts, ctx = V.facts_h(spark, d), V.ctx_h(spark, d)
        assert facts.count() == V.table(spark, d, "events").count()
        assert K.anti_join(ctx, facts, "hour_begin", "fact_hour").count() > 0
        assert K.anti_join(facts, ctx, "fact_hour", "hour_begin").count() > 0
        hours = Q.hours_with_crashes(ctx, facts).groupBy("has_accident").count().collect()
        assert {r.has_accident for r in hours} == {0, 1}
        training = Q.training_table(ctx, facts).groupBy("has_accident").count().collect()
        assert len(training) == 2 or sf == "sf0.001"


@pytest.mark.skipif(not SF.endswith("sf0.01"), reason="figures are for sf0.01")
@needs_data
def test_survey_figures_at_sf001(spark):
    """Figures the survey measured independently: error events as crashes, the others but for 3 a.m. as context."""
    import __spark_entry__ as E
    from hourglass.functions.scalars import decode_weather, trunc_time
    from hourglass.operators import aggregate, model
    q = E.queries()
    events = V.table(spark, SF, "events")
    facts = V._facts(events.filter("event_type = 'error'"))
    ctx = events.filter((F.col("event_type") != "error") & (F.hour("ts") != 3)).groupBy(
        trunc_time("ts").alias("hour_begin")).agg(
        F.count(F.lit(1)).cast("int").alias("pedestrians"), F.max("value").alias("temperature"),
        F.min("value").alias("precipitation"), F.min("user_id").alias("m")).select(
        "hour_begin", "pedestrians", "temperature", "precipitation",
        decode_weather((F.col("m") % 11).cast("int")).alias("weather_summary"),
        F.when(F.col("m") % 7 == 0, "parade").alias("event_name"))
    assert K.context_left_facts(ctx, facts, "hour_begin", "fact_hour").count() == 1973
    assert K.anti_join(ctx, facts, "hour_begin", "fact_hour").count() == 41
    assert facts.count() == 2014
    assert ctx.count() == 690 and ctx.filter("weather_summary IS NULL").count() == 47
    joined = K.facts_left_context(facts, ctx, "fact_hour", "hour_begin", drop_null=["weather_summary"])
    assert aggregate.factor_share_by_weather(joined).count() == 70
    assert aggregate.casualties_by_weather_factor(joined).count() == 70
    assert q["q5_factor_share_daily"](spark, SF).count() == 60
    stats = model.chi_square(Q.hours_with_crashes(ctx, facts), ["hour_group"], "has_accident").first()
    assert (round(stats.statistic, 6), stats.dof) == (8.181693, 5)
    # raw lines: unchanged, repaired by the parenthesis rule, by the quote rule,
    # quarantined with both problems, quarantined as too short
    from hourglass.functions import lines as L
    lines = V.crash_lines(spark, SF).filter("line_key > 0")
    long_, paren = L.comma_count("value") > 28, F.col("value").rlike(r"\(.*\)")
    ok = F.size(L.split_fields(L.repair_delimiters("value"))) == 29
    r = lines.agg(F.count_if(~long_ & ok), F.count_if(long_ & paren & ok), F.count_if(long_ & ~paren & ok),
                  F.count_if(long_ & ~ok), F.count_if(~long_ & ~ok)).first()
    assert tuple(r) == (7589, 3764, 1882, 941, 824)
