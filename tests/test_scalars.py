"""X1-X21, F1-F7, J2, J3 on inline rows (FIXTURES §3)."""

import datetime as dt

from pyspark.sql import functions as F

from hourglass.functions import scalars as X
from hourglass.operators import filters as FL
from hourglass.operators import scale as S


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


def test_parse_crash_ts_and_date(spark):
    df = one_col(spark, ["10/01/2017 0:05", "12/31/2019 23:59", "", "x", None])
    got = [r[0] for r in df.select(X.parse_crash_ts("v")).collect()]
    assert got == [dt.datetime(2017, 10, 1, 0, 5), dt.datetime(2019, 12, 31, 23, 59), None, None, None]
    dates = one_col(spark, ["10/01/2017", "bad"]).select(X.parse_crash_date("v")).collect()
    assert [r[0] for r in dates] == [dt.date(2017, 10, 1), None]
    assert df.select(X.parse_crash_ts("v").alias("t")).dtypes == [("t", "timestamp_ntz")]


def test_parse_context_ts_12_hour(spark):
    df = one_col(spark, ["10/01/2017 12:00:00 AM", "10/01/2017 01:00:00 PM", "10/01/2017 1:5:7 PM", None])
    got = [r[0] for r in df.select(X.parse_context_ts("v")).collect()]
    assert got == [dt.datetime(2017, 10, 1, 0, 0), dt.datetime(2017, 10, 1, 13, 0),
                   dt.datetime(2017, 10, 1, 13, 5, 7), None]


def test_concat_date_time_null(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "d string, t string")
    assert [r[0] for r in df.select(X.concat_date_time("d", "t")).collect()] == ["a b", None]


def test_filter_date_open_excludes_both_ends(spark):
    days = [dt.date(2017, 9, 30), dt.date(2017, 10, 1), dt.date(2019, 12, 31), dt.date(2020, 1, 1)]
    df = one_col(spark, days, "date")
    kept = [r.v for r in FL.filter_date_open(df, "v", "2017-09-30", "2020-01-01").collect()]
    assert kept == days[1:3]


def test_filter_valid_geo(spark):
    df = spark.createDataFrame([(40.7, -73.9), (-1.0, -1.0), (0.0, -73.9), (40.7, -2.0)],
                               "latitude double, longitude double")
    assert FL.filter_valid_geo(df).collect() == [(40.7, -73.9)]


def test_hour_group_and_days(spark):
    ts = [dt.datetime(2017, 10, 1, h) for h in (0, 3, 4, 11, 12, 23)]
    df = one_col(spark, ts, "timestamp_ntz")
    assert [r[0] for r in df.select(X.hour_group("v")).collect()] == [0, 0, 1, 2, 3, 5]
    days = one_col(spark, [dt.datetime(2017, 10, 1), dt.datetime(2017, 10, 2)], "timestamp_ntz")
    assert [tuple(r) for r in days.select(X.day_monday_first("v"), X.day_of_week("v")).collect()] \
        == [(7, 1), (1, 2)]


def test_trunc_time_keeps_ntz(spark):
    df = one_col(spark, [dt.datetime(2017, 10, 1, 13, 45, 12)], "timestamp_ntz")
    out = df.select(*[X.trunc_time("v", u).alias(u) for u in ("year", "month", "day", "hour", "minute")])
    assert all(t == "timestamp_ntz" for _, t in out.dtypes)
    assert tuple(out.first()) == (dt.datetime(2017, 1, 1), dt.datetime(2017, 10, 1), dt.datetime(2017, 10, 1),
                                  dt.datetime(2017, 10, 1, 13), dt.datetime(2017, 10, 1, 13, 45))


def test_weather_encoding_and_recode(spark):
    df = one_col(spark, ["sleet", "clear-day", "tornado", None])
    assert [r[0] for r in df.select(X.encode_weather("v")).collect()] == [0, 9, None, None]
    assert [r[0] for r in df.select(X.recode("v", {"sleet": "s"}, "other")).collect()] \
        == ["s", "other", "other", "other"]


def test_sentinel_to_label(spark):
    df = one_col(spark, ["-1", "Unspecified", "Driver Inattention", None])
    assert [r[0] for r in df.select(X.sentinel_to_label("v")).collect()] \
        == ["Unspecified", "Unspecified", "Driver Inattention", None]


def test_labels_on_null_zero_two(spark):
    df = one_col(spark, [None, 0, 2], "int")
    got = [tuple(r) for r in df.select(X.label_any_match("v"), X.label_positive("v"),
                                       X.null_flag("v"), X.null_to_zero("v")).collect()]
    assert got == [(0, 1, 0, 0), (1, 0, 1, 0), (1, 1, 1, 2)]


def test_tolerant_casts_and_row_sum(spark):
    df = spark.createDataFrame([("1", "2", "3"), ("", "2", "3"), ("x", "1", "1")], "a string, b string, c string")
    typed = FL.cast_cols(df, {"a": "int", "b": "int", "c": "int"})
    assert [r.s for r in FL.row_sum(typed, ["a", "b", "c"], "s").collect()] == [6, None, None]


def test_min_max_scale_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (2.0, 5.0)], "x double, c double")
    out = S.min_max_scale(df, ["x", "c"]).orderBy("x").collect()
    assert [r.x_norm for r in out] == [0.0, 0.5, 1.0]
    assert [r.c_norm for r in out] == [None, None, None]


def test_fixed_and_max_scale(spark):
    df = one_col(spark, [1, 7], "int")
    got = df.select(S.fixed_range_scale("v", 1, 7), S.max_scale("v", 4)).collect()
    assert [tuple(r) for r in got] == [(0.0, 0.25), (1.0, 1.75)]


def test_norm_params_long_table(spark):
    df = spark.createDataFrame([(3.0, 10), (96.0, 20)], "temperature double, pedestrians int")
    out = S.norm_params(df, [("temperature", "temperature"), ("pedestrians", "pedestrians")],
                        [("weather", 0, 9)]).collect()
    assert [tuple(r) for r in out] == [("temperature", 3.0, 96.0), ("pedestrians", 10.0, 20.0),
                                       ("weather", 0.0, 9.0)]


def test_fraction_zero_denominator(spark):
    df = spark.createDataFrame([(1, 2), (1, 0)], "a long, b long")
    assert [r[0] for r in df.select(X.fraction("a", "b")).collect()] == [0.5, None]
    assert df.select(F.lit(1)).count() == 2


def test_wall_clock_semantics_in_a_dst_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = one_col(spark, ["03/10/2024 2:30", "bad"])
        got = df.select(X.parse_crash_ts("v").alias("t")).select("t", X.trunc_time("t").alias("h")).collect()
        assert tuple(got[0]) == (dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10, 2, 0))
        assert tuple(got[1]) == (None, None)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
