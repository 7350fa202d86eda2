"""Registered queries: one per operator of the inventory, each with its SQL oracle
when SQL can express it.

Every query reads the driver tables at ``sf_dir`` through the look-alike views, so
its work grows with the tables. Keys are ``<operator id>_<name>``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.functions import lines as L
from hourglass.functions import scalars as X
from hourglass.operators import aggregate as A
from hourglass.operators import clean as C
from hourglass.operators import filters as FL
from hourglass.operators import joins as K
from hourglass.operators import model as M
from hourglass.operators import order as O
from hourglass.operators import profile as P
from hourglass.operators import sample as B
from hourglass.operators import scale as S
from hourglass.plans import analyses as Q
from hourglass.plans import lookalike as V
from hourglass.plans.oracle import (
    CONTEXT_KEEP_ORDINALS,
    hash_bucket,
    hash_pick,
    hours_with_crashes_sql,
    q,
    row_key,
    split_pick,
    weather_code,
    with_views,
)
from hourglass.session import checkpoint_root, materialize, scratch_path
from hourglass.sources import io

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# Fixed parameters of the checks.
BOROUGH = "ERROR"
DATE_LO, DATE_HI = "2024-01-03", "2024-01-28"
AREA_ZIP = "11202"
BUCKETS = 16
SEGMENT_CODES = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4}
FS = Q.FINAL_SAMPLE


def r6(c):
    return F.round(c, 6)


# =============================================================================
# Sources and sinks
# =============================================================================

@register("s1_read_lines", with_views("SELECT value FROM crash_lines", "crash_lines"))
def s1_read_lines(spark, d):
    path = scratch_path(spark, "s1")
    V.crash_lines(spark, d).select("value").write.mode("overwrite").text(path)
    return io.read_lines(spark, path)


_OFFSETS_SQL = """
SELECT CAST(coalesce(sum(octet_length(encode(value)) + 1) OVER (
         ORDER BY line_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS {key}, value
FROM crash_lines"""


def _numbered_lines(spark, d) -> DataFrame:
    """The crash lines in key order, written as range-partitioned files and read with places over all files."""
    path = scratch_path(spark, "s1-offsets")
    parts = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    V.crash_lines(spark, d).repartitionByRange(parts, "line_key").sortWithinPartitions("line_key").select("value").write.text(path)
    return io.number_lines(spark, path)


@register("s1_read_lines_offsets", with_views(_OFFSETS_SQL.format(key='"offset"'), "crash_lines"))
def s1_read_lines_offsets(spark, d):
    return _numbered_lines(spark, d).select("offset", "value")


@register("c8_offset_row_key", with_views(_OFFSETS_SQL.format(key="row_key"), "crash_lines"))
def c8_offset_row_key(spark, d):
    """C8 with generated keys: the byte offset of each line."""
    return C.with_row_key(_numbered_lines(spark, d).drop("line_no"), "offset").select("row_key", "value")


@register("c8_dense_row_key", with_views(
    "SELECT CAST(row_number() OVER (ORDER BY line_key) - 1 AS BIGINT) AS row_key, value FROM crash_lines", "crash_lines"))
def c8_dense_row_key(spark, d):
    """C8 with generated keys without gaps: the number of each line over all files."""
    return C.with_row_key(_numbered_lines(spark, d).drop("offset"), "line_no").select("row_key", "value")


@register("s2_read_csv_strings", with_views(
    "SELECT CAST(row_id AS VARCHAR) AS row_id, crash_date, crash_time, borough, zip_code, ped_injured, "
    "ped_killed, cyc_injured, cyc_killed, mot_injured, mot_killed, factor_1 FROM crash_raw", "crash_raw"))
def s2_read_csv_strings(spark, d):
    raw = V.crash_raw(spark, d)
    path = scratch_path(spark, "s2")
    io.write_csv(raw, path, null_value="\\N")
    return io.read_csv_strings(spark, path, raw.columns, null_value="\\N")


def _a1_hourly(spark, d) -> DataFrame:
    joined = K.facts_left_context(V.facts_h(spark, d), V.ctx_h(spark, d), "fact_hour", "hour_begin",
                                  drop_null=["weather_summary"])
    return A.factor_share_by_weather(joined)


A1_SQL = """
SELECT weather_summary AS weather, factor,
       sum(count(*)) OVER (PARTITION BY weather_summary) AS weather_count,
       count(factor) AS weather_factor_count,
       CAST(count(factor) AS DOUBLE) / CAST(sum(count(*)) OVER (PARTITION BY weather_summary) AS DOUBLE) AS frac
FROM {src} GROUP BY weather_summary, factor"""

K2_RAW = """SELECT f.*, c.* FROM facts_h f JOIN ctx_h c ON f.fact_hour = c.hour_begin
WHERE c.weather_summary IS NOT NULL"""


def _a1_sql_raw() -> str:
    return with_views("SELECT weather, factor, CAST(weather_count AS BIGINT) AS weather_count, "
                      "weather_factor_count, frac FROM (" + A1_SQL.format(src="k2") + ") t",
                      "facts_h", "ctx_h", extra={"k2": K2_RAW})


@register("s3_write_csv", _a1_sql_raw())
def s3_write_csv(spark, d):
    path = scratch_path(spark, "s3")
    io.write_csv(_a1_hourly(spark, d), path, single_file=True)
    schema = "weather string, factor string, weather_count bigint, weather_factor_count bigint, frac double"
    return spark.read.option("header", True).schema(schema).csv(path)


def _q1(spark, d) -> DataFrame:
    return Q.prepare_facts(V.crash_raw(spark, d), BOROUGH, DATE_LO, DATE_HI)


Q1_BODY = f"""
SELECT row_id AS fact_id, crash_ts, date_trunc('hour', crash_ts) AS fact_hour, zip_code,
       TRY_CAST(ped_injured AS INTEGER) + TRY_CAST(cyc_injured AS INTEGER) + TRY_CAST(mot_injured AS INTEGER) AS injured,
       TRY_CAST(ped_killed AS INTEGER) + TRY_CAST(cyc_killed AS INTEGER) + TRY_CAST(mot_killed AS INTEGER) AS killed,
       CASE WHEN factor_1 = '-1' THEN 'Unspecified' ELSE factor_1 END AS factor
FROM (SELECT *, try_strptime(concat(crash_date, ' ', crash_time), '%m/%d/%Y %H:%M') AS crash_ts,
             CAST(try_strptime(crash_date, '%m/%d/%Y') AS DATE) AS crash_day
      FROM crash_raw WHERE borough = {q(BOROUGH)}) r
WHERE crash_day > DATE '{DATE_LO}' AND crash_day < DATE '{DATE_HI}'"""
Q1_SQL = with_views(Q1_BODY, "crash_raw")


@register("s4_save_stage", Q1_SQL)
def s4_save_stage(spark, d):
    path = scratch_path(spark, "s4")
    io.save_stage(_q1(spark, d), path)
    return io.load_stage(spark, path)


def _c13(spark, d) -> DataFrame:
    return C.clean_crash_lines(V.crash_lines(spark, d), key_col="line_key", keep_flag=True)


@register("s4_bucketed_join", with_views(
    "SELECT f.*, c.* FROM facts_d f JOIN ctx_d c ON f.fact_day = c.day_begin", "facts_d", "ctx_d"))
def s4_bucketed_join(spark, d):
    """S4 laid out for reuse: both sides stored bucketed on the time key, joined without a shuffle."""
    pair = K.bucketed_pair(V.facts_d(spark, d), V.ctx_d(spark, d), "fact_day", "day_begin", BUCKETS, salt=2)
    return K.join_buckets(*pair, "fact_day", "day_begin")


@register("s5_write_lines", with_views("SELECT DISTINCT cells_line AS value FROM crash_clean", "crash_clean"))
def s5_write_lines(spark, d):
    path = scratch_path(spark, "s5")
    lines = C.distinct_lines(_cleaned_cells_lines(spark, d), sort=False)
    io.write_lines(lines, path)
    return io.read_lines(spark, path)


def _cleaned_cells_lines(spark, d) -> DataFrame:
    """Cleaned cells without the row key (C9 output)."""
    cells = C.crash_cells(V.crash_lines(spark, d), key_col="line_key")
    return cells.select(L.join_fields([F.col("cells")]).alias("value"))


P1_SQL = with_views(f"""
SELECT {q(P.RECORDS_LABEL)} AS label,
       count(*) FILTER (WHERE split_part(value, ',', 1) NOT IN ('CRASH DATE', '0')) AS n_records
FROM crash_lines""", "crash_lines")
P1_CLEAN_SQL = with_views(f"""
SELECT {q(P.RECORDS_LABEL)} AS label,
       count(*) FILTER (WHERE split_part(value, ',', 1) NOT IN ('CRASH DATE', '0')) AS n_records
FROM crash_clean""", "crash_clean")


@register("s6_write_kv", P1_CLEAN_SQL)
def s6_write_kv(spark, d):
    path = scratch_path(spark, "s6")
    io.write_kv(P.count_records(_c13(spark, d)), path, sep=",")
    back = io.read_kv(spark, path, ["label", "n_records"])
    return back.select("label", F.col("n_records").cast("bigint").alias("n_records"))


def _training(spark, d) -> DataFrame:
    return Q.training_table(V.ctx_h(spark, d), V.facts_h(spark, d))


def _labelled(spark, d, features=Q.FINAL_FEATURES) -> DataFrame:
    checkpoint_root(spark)
    t = _training(spark, d)
    return M.index_label(M.assemble(t, list(features)), "has_accident")


def _rows(spark, rows, schema) -> DataFrame:
    return io.rows_to_table(spark, rows, schema)


METRIC_SCHEMA = "model string, metric string, value double"
TERM_SCHEMA = "term string, value double"


@register("s7_save_model")
def s7_save_model(spark, d):
    data = _labelled(spark, d)
    model = M.fit_logistic(data, max_iter=50)
    path = scratch_path(spark, "s7")
    io.save_model(model, path)
    loaded = io.load_model(path, "logistic")
    return _rows(spark, M.coefficients(loaded, list(Q.FINAL_FEATURES)), TERM_SCHEMA)


# =============================================================================
# Line cleaning
# =============================================================================

@register("c1_repair_delimiters", with_views("SELECT line_key, rep AS value FROM crash_cells", "crash_cells"))
def c1_repair_delimiters(spark, d):
    return V.crash_lines(spark, d).select("line_key", L.repair_delimiters("value").alias("value"))


@register("c2_strip_parenthesised", with_views(
    "SELECT line_key, regexp_replace(value, '\\(.*\\)', '', 'g') AS value FROM crash_lines", "crash_lines"))
def c2_strip_parenthesised(spark, d):
    return V.crash_lines(spark, d).select("line_key", L.strip_parenthesised("value").alias("value"))


@register("c3_unquote_comma", with_views(
    "SELECT line_key, regexp_replace(value, '\"(.*),(.*)\"', '\\1\\2', 'g') AS value FROM crash_lines",
    "crash_lines"))
def c3_unquote_comma(spark, d):
    return V.crash_lines(spark, d).select("line_key", L.unquote_comma("value").alias("value"))


@register("c4_split_fields", with_views(
    "SELECT line_key, CAST(len(cells) AS INTEGER) AS n_fields, array_to_string(cells, '|') AS cells "
    "FROM crash_cells", "crash_cells"))
def c4_split_fields(spark, d):
    arr = L.split_fields(L.repair_delimiters("value"))
    return V.crash_lines(spark, d).select(
        "line_key", F.size(arr).alias("n_fields"), F.array_join(arr, "|").alias("cells"))


_KEPT_IDX = [i for i in range(L.CRASH_FIELDS) if i not in L.CRASH_DROP_ORDINALS]


def _well_formed_cells(spark, d) -> DataFrame:
    """Lines with exactly 29 cells after repair, as cell arrays (C4 + C7 as a filter)."""
    split = L.split_fields(L.repair_delimiters("value")).alias("cells")
    cells = V.crash_lines(spark, d).select(C.computed_once(F.col("line_key"), split))
    return cells.filter(F.size("cells") == L.CRASH_FIELDS)


@register("c5_project_ordinals", with_views(
    "SELECT line_key, concat_ws('|', " + ", ".join(f"cells[{i + 1}]" for i in _KEPT_IDX) + ") AS cells "
    f"FROM crash_cells WHERE len(cells) = {L.CRASH_FIELDS}", "crash_cells"))
def c5_project_ordinals(spark, d):
    return _well_formed_cells(spark, d).select(
        "line_key", F.concat_ws("|", *L.project_ordinals("cells")).alias("cells"))


@register("c6_fill_empty", with_views(
    "SELECT line_key, concat_ws('|', " + ", ".join(
        f"CASE WHEN cells[{i + 1}] = '' THEN '-1' ELSE cells[{i + 1}] END" for i in range(L.CRASH_FIELDS))
    + f") AS cells FROM crash_cells WHERE len(cells) = {L.CRASH_FIELDS}", "crash_cells"))
def c6_fill_empty(spark, d):
    return _well_formed_cells(spark, d).select(
        "line_key", F.concat_ws("|", *[L.fill_empty(F.try_element_at("cells", F.lit(i + 1)))
                                      for i in range(L.CRASH_FIELDS)]).alias("cells"))


@register("c7_quarantine_malformed", with_views(
    f"SELECT line_key, len(cells) <> {L.CRASH_FIELDS} AS is_malformed FROM crash_cells", "crash_cells"))
def c7_quarantine_malformed(spark, d):
    return C.quarantine_malformed(V.crash_lines(spark, d)).select("line_key", "is_malformed")


@register("c8_with_row_key", with_views("SELECT line_key AS row_key, value FROM crash_lines", "crash_lines"))
def c8_with_row_key(spark, d):
    return C.with_row_key(V.crash_lines(spark, d), "line_key").select("row_key", "value")


@register("c9_join_fields", with_views("SELECT row_key, cells_line AS value FROM crash_clean", "crash_clean"))
def c9_join_fields(spark, d):
    cells = C.crash_cells(V.crash_lines(spark, d), key_col="line_key")
    return cells.select("row_key", L.join_fields([F.col("cells")]).alias("value"))


@register("c10_distinct_lines", with_views("SELECT DISTINCT cells_line AS value FROM crash_clean",
                                           "crash_clean"))
def c10_distinct_lines(spark, d):
    return C.distinct_lines(_cleaned_cells_lines(spark, d))


def _ctx_line_sql(filtered: bool) -> str:
    need = max(CONTEXT_KEEP_ORDINALS) + 1
    cells = ", ".join(f"cells[{i + 1}]" for i in CONTEXT_KEEP_ORDINALS)
    where = ""
    if filtered:
        where = ("WHERE NOT coalesce(line_key = 0 AND contains(value, 'location'), false) "
                 "AND NOT coalesce(cells[6] = '', true) "
                 "AND NOT coalesce(TRY_CAST(cells[3] AS INTEGER) = 0, false)")
    return with_views(f"""
SELECT line_key, CASE WHEN len(cells) < {need} THEN NULL ELSE concat_ws(',', {cells}) END AS value,
       len(cells) < {need} AS is_short
FROM ctx_cells_all {where}""", "ctx_cells_all")


@register("c11_clean_context_lines", _ctx_line_sql(False))
def c11_clean_context_lines(spark, d):
    return C.clean_context_lines(V.ctx_lines_all(spark, d), key_col="line_key")


@register("c12_drop_header_and_empty", _ctx_line_sql(True))
def c12_drop_header_and_empty(spark, d):
    return C.clean_context_lines(V.ctx_lines_all(spark, d), key_col="line_key", drop_rows=True)


@register("c13_clean_crash_lines", with_views("SELECT row_key, is_malformed, value FROM crash_clean",
                                              "crash_clean"))
def c13_clean_crash_lines(spark, d):
    return _c13(spark, d)


# =============================================================================
# Profiling
# =============================================================================

@register("p1_count_records", P1_SQL)
def p1_count_records(spark, d):
    return P.count_records(V.crash_lines(spark, d))


@register("p2_count_records_skip_header", with_views(
    "SELECT count(*) FILTER (WHERE NOT coalesce(line_key = 0 AND contains(value, 'location'), false)) "
    "AS n_records FROM ctx_lines_all", "ctx_lines_all"))
def p2_count_records_skip_header(spark, d):
    return P.count_records_skip_header(V.ctx_lines_all(spark, d), key_col="line_key")


@register("p3_count_rows", with_views("SELECT count(*) AS n_rows FROM facts_d", "facts_d"))
def p3_count_rows(spark, d):
    return P.row_count(V.facts_d(spark, d))


_P4_COLS = ["fact_id", "injured", "killed", "factor", "weather_summary", "event_name", "temperature"]


def _hwc(spark, d) -> DataFrame:
    return Q.hours_with_crashes(V.ctx_h(spark, d), V.facts_h(spark, d))


@register("p4_null_counts", with_views(
    "SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in _P4_COLS)
    + " FROM hwc_h", "hwc_h"))
def p4_null_counts(spark, d):
    return P.null_counts(_hwc(spark, d), _P4_COLS)


# Cleaned-line positions (key at 0): zip 4, off street 9, factor 3 at 18, vehicle 3 at 24.
_P5 = {"zip_code": 4, "off_street": 9, "factor_3": 18, "vehicle_3": 24}


@register("p5_sentinel_counts", with_views(
    "SELECT " + ", ".join(f"count(*) FILTER (WHERE string_split(value, ',')[{i + 1}] = '-1') AS {n}"
                          for n, i in _P5.items()) + " FROM crash_clean", "crash_clean"))
def p5_sentinel_counts(spark, d):
    table = C.crash_table(V.crash_lines(spark, d), key_col="line_key")
    return P.sentinel_counts(table, list(_P5))


@register("p6_value_counts", with_views("SELECT factor, count(*) AS count FROM facts_all GROUP BY factor",
                                        "facts_all"))
def p6_value_counts(spark, d):
    return P.value_counts(V.facts_all(spark, d), "factor")


@register("p7_value_counts_by_key", with_views(
    "SELECT pedestrians, count(*) AS count FROM ctx_all GROUP BY pedestrians", "ctx_all"))
def p7_value_counts_by_key(spark, d):
    return P.value_counts(V.ctx_all(spark, d), "pedestrians", sort="value")


@register("p8_count_distinct", with_views(
    "SELECT count(DISTINCT factor) AS factor, count(DISTINCT zip_code) AS zip_code FROM facts_d", "facts_d"))
def p8_count_distinct(spark, d):
    return P.count_distinct(V.facts_d(spark, d), ["factor", "zip_code"])


@register("p9_min_max", with_views(
    "SELECT min(injured) AS min_injured, max(injured) AS max_injured, min(killed) AS min_killed, "
    "max(killed) AS max_killed, min(crash_ts) AS min_crash_ts, max(crash_ts) AS max_crash_ts FROM facts_d",
    "facts_d"))
def p9_min_max(spark, d):
    return P.min_max(V.facts_d(spark, d), ["injured", "killed", "crash_ts"])


@register("p10_describe", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS column, count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 6) AS mean, "
    f"round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
    f"CAST(max({c}) AS DOUBLE) AS max FROM ctx_all" for c in ("pedestrians", "temperature")), "ctx_all"))
def p10_describe(spark, d):
    out = P.describe(V.ctx_all(spark, d), ["pedestrians", "temperature"])
    return out.withColumns({"mean": r6(F.col("mean")), "stddev": r6(F.col("stddev"))})


@register("p11_distinct_values", with_views("SELECT DISTINCT weather_summary FROM cw_h", "cw_h"))
def p11_distinct_values(spark, d):
    joined = Q.crashes_with_weather(V.facts_h(spark, d), V.ctx_h(spark, d))
    return P.distinct_values(joined, "weather_summary")


@register("p13_class_balance", with_views(
    "SELECT has_accident, count(*) AS count FROM hwc_h GROUP BY has_accident", "hwc_h"))
def p13_class_balance(spark, d):
    return P.class_balance(_hwc(spark, d), "has_accident")


# =============================================================================
# Filters and projections
# =============================================================================

@register("f1_filter_eq", with_views("SELECT * FROM geo WHERE zip_code = '7'", "geo"))
def f1_filter_eq(spark, d):
    return FL.filter_eq(V.geo(spark, d), "zip_code", "7")


@register("f2_filter_date_open", with_views(f"""
SELECT row_id, crash_day FROM (
  SELECT row_id, CAST(try_strptime(crash_date, '%m/%d/%Y') AS DATE) AS crash_day FROM crash_raw) r
WHERE crash_day > DATE '{DATE_LO}' AND crash_day < DATE '{DATE_HI}'""", "crash_raw"))
def f2_filter_date_open(spark, d):
    df = V.crash_raw(spark, d).select("row_id", X.parse_crash_date("crash_date").alias("crash_day"))
    return FL.filter_date_open(df, "crash_day", DATE_LO, DATE_HI)


@register("f3_filter_valid_geo", with_views(
    "SELECT * FROM geo WHERE latitude > 0 AND longitude < -2", "geo"))
def f3_filter_valid_geo(spark, d):
    return FL.filter_valid_geo(V.geo(spark, d))


@register("f4_filter_null", with_views(
    "SELECT hour_begin, weather_summary FROM hwc_h WHERE fact_id IS NULL", "hwc_h"))
def f4_filter_null(spark, d):
    return FL.filter_null(_hwc(spark, d), "fact_id").select("hour_begin", "weather_summary")


@register("f5_drop_null_rows", with_views("SELECT * FROM ctx_all WHERE weather_summary IS NOT NULL", "ctx_all"))
def f5_drop_null_rows(spark, d):
    return FL.drop_null_rows(V.ctx_all(spark, d), ["weather_summary"])


@register("f6_filter_cmp", with_views(
    "SELECT hour_begin, fact_id, casualties FROM hwc_h WHERE casualties > 0", "hwc_h"))
def f6_filter_cmp(spark, d):
    return FL.filter_cmp(_hwc(spark, d), "casualties", ">", 0).select("hour_begin", "fact_id", "casualties")


def _q5(spark, d) -> DataFrame:
    return Q.factor_share(V.facts_h(spark, d), V.ctx_h(spark, d))


def _q5_sql(src: str = "cw_h", tail: str = "") -> str:
    return with_views("SELECT weather, factor, CAST(weather_count AS BIGINT) AS weather_count, "
                      "weather_factor_count, frac FROM (" + A1_SQL.format(src=src) + ") t " + tail, src)


@register("f7_filter_not_eq", _q5_sql(tail="WHERE factor <> 'Unspecified'"))
def f7_filter_not_eq(spark, d):
    return FL.filter_not_eq(_q5(spark, d), "factor", "Unspecified")


@register("j0_select_cols", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def j0_select_cols(spark, d):
    return FL.select_cols(V.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_quantity"])


@register("j1_drop_cols", with_views("SELECT fact_id, fact_hour, factor, injured, killed FROM facts_all",
                                     "facts_all"))
def j1_drop_cols(spark, d):
    return FL.drop_cols(V.facts_all(spark, d), ["crash_ts", "zip_code"])


_COUNTS = ["ped_injured", "ped_killed", "cyc_injured", "cyc_killed", "mot_injured", "mot_killed"]


@register("j2_cast_cols", with_views(
    "SELECT row_id, " + ", ".join(f"TRY_CAST({c} AS INTEGER) AS {c}" for c in _COUNTS) + " FROM crash_raw",
    "crash_raw"))
def j2_cast_cols(spark, d):
    return FL.cast_cols(V.crash_raw(spark, d).select("row_id", *_COUNTS), {c: "int" for c in _COUNTS})


@register("j3_row_sum", with_views(
    "SELECT row_id, TRY_CAST(ped_injured AS INTEGER) + TRY_CAST(cyc_injured AS INTEGER) + "
    "TRY_CAST(mot_injured AS INTEGER) AS injured FROM crash_raw", "crash_raw"))
def j3_row_sum(spark, d):
    df = FL.cast_cols(V.crash_raw(spark, d), {c: "int" for c in _COUNTS})
    return FL.row_sum(df, ["ped_injured", "cyc_injured", "mot_injured"], "injured").select("row_id", "injured")


# =============================================================================
# Scalar functions
# =============================================================================

@register("x1_concat_date_time", with_views(
    "SELECT row_id, concat(crash_date, ' ', crash_time) AS crash_dt FROM crash_raw", "crash_raw"))
def x1_concat_date_time(spark, d):
    return V.crash_raw(spark, d).select("row_id", X.concat_date_time("crash_date", "crash_time").alias("crash_dt"))


@register("x2_parse_crash_ts", with_views(
    "SELECT row_id, try_strptime(concat(crash_date, ' ', crash_time), '%m/%d/%Y %H:%M') AS crash_ts "
    "FROM crash_raw", "crash_raw"))
def x2_parse_crash_ts(spark, d):
    return V.crash_raw(spark, d).select(
        "row_id", X.parse_crash_ts(X.concat_date_time("crash_date", "crash_time")).alias("crash_ts"))


@register("x3_parse_crash_date", with_views(
    "SELECT row_id, CAST(try_strptime(crash_date, '%m/%d/%Y') AS DATE) AS crash_day FROM crash_raw",
    "crash_raw"))
def x3_parse_crash_date(spark, d):
    return V.crash_raw(spark, d).select("row_id", X.parse_crash_date("crash_date").alias("crash_day"))


@register("x4_parse_context_ts", with_views(
    "SELECT ctx_key, try_strptime(hour_beginning, '%m/%d/%Y %I:%M:%S %p') AS hour_begin FROM ctx_raw_all",
    "ctx_raw_all"))
def x4_parse_context_ts(spark, d):
    return V.ctx_raw_all(spark, d).select("ctx_key", X.parse_context_ts("hour_beginning").alias("hour_begin"))


_UNITS = ("year", "month", "day", "hour", "minute")


@register("x5_trunc_time", with_views(
    "SELECT fact_id, " + ", ".join(f"date_trunc('{u}', crash_ts) AS t_{u}" for u in _UNITS) + " FROM facts_all",
    "facts_all"))
def x5_trunc_time(spark, d):
    return V.facts_all(spark, d).select("fact_id", *[X.trunc_time("crash_ts", u).alias(f"t_{u}") for u in _UNITS])


@register("x6_hour_of", with_views("SELECT fact_id, CAST(hour(crash_ts) AS INTEGER) AS hour FROM facts_all",
                                   "facts_all"))
def x6_hour_of(spark, d):
    return V.facts_all(spark, d).select("fact_id", X.hour_of("crash_ts").alias("hour"))


@register("x7_hour_group", with_views(
    "SELECT fact_id, CAST(floor(hour(crash_ts) / 4) AS INTEGER) AS hour_group FROM facts_all", "facts_all"))
def x7_hour_group(spark, d):
    return V.facts_all(spark, d).select("fact_id", X.hour_group("crash_ts").alias("hour_group"))


@register("x8_day_of_week", with_views(
    "SELECT fact_id, CAST(dayofweek(crash_ts) + 1 AS INTEGER) AS day_of_week FROM facts_d", "facts_d"))
def x8_day_of_week(spark, d):
    return V.facts_d(spark, d).select("fact_id", X.day_of_week("crash_ts").alias("day_of_week"))


@register("x9_day_monday_first", with_views(
    "SELECT fact_id, CAST(isodow(crash_ts) AS INTEGER) AS day FROM facts_d", "facts_d"))
def x9_day_monday_first(spark, d):
    return V.facts_d(spark, d).select("fact_id", X.day_monday_first("crash_ts").alias("day"))


@register("x10_recode", with_views(
    "SELECT geo_id, coalesce(CASE segment " + " ".join(f"WHEN {q(k)} THEN {v}" for k, v in SEGMENT_CODES.items())
    + " END, 0) AS segment_code FROM geo", "geo"))
def x10_recode(spark, d):
    return V.geo(spark, d).select("geo_id", X.recode("segment", SEGMENT_CODES, 0).alias("segment_code"))


_X10_SQL = """
SELECT l_linenumber, l_orderkey, coalesce(o_custkey, -1) AS customer
FROM (SELECT l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN -l_orderkey ELSE l_orderkey END AS l_orderkey
      FROM lineitem) l LEFT JOIN orders ON l_orderkey = o_orderkey"""


def _orders_of_items(spark, d, **how) -> DataFrame:
    """Line items recoded by a mapping as large as the orders; some keys unknown, some null."""
    number, key = F.col("l_linenumber"), F.col("l_orderkey")
    items = V.table(spark, d, "lineitem").select("l_linenumber", F.when(number == 6, -key).when(number != 7, key).alias("l_orderkey"))
    return K.lookup(items, "l_orderkey", V.table(spark, d, "orders"), "o_orderkey", "o_custkey", out="customer", default=-1, **how)


@register("x10_recode_large_mapping", _X10_SQL)
def x10_recode_large_mapping(spark, d):
    """X10 with a mapping table: broadcast where it is small enough."""
    return _orders_of_items(spark, d)


@register("x10_recode_large_mapping_shuffle", _X10_SQL)
def x10_recode_large_mapping_shuffle(spark, d):
    """X10 with a mapping above the broadcast bound: shuffled, hot keys salted, rows without a key kept out."""
    return _orders_of_items(spark, d, max_broadcast_bytes=1024, salt=4)


@register("x11_encode_weather", with_views(
    f"SELECT hour_begin, {weather_code('weather_summary')} AS weather FROM ctx_all", "ctx_all"))
def x11_encode_weather(spark, d):
    return V.ctx_all(spark, d).select("hour_begin", X.encode_weather("weather_summary").alias("weather"))


@register("x12_sentinel_to_label", with_views(
    "SELECT fact_id, CASE WHEN factor = '-1' THEN 'Unspecified' ELSE factor END AS factor FROM facts_all",
    "facts_all"))
def x12_sentinel_to_label(spark, d):
    return V.facts_all(spark, d).select("fact_id", X.sentinel_to_label("factor").alias("factor"))


@register("x13_null_flag", with_views(
    "SELECT hour_begin, CASE WHEN event_name IS NULL THEN 0 ELSE 1 END AS has_event FROM ctx_all", "ctx_all"))
def x13_null_flag(spark, d):
    return V.ctx_all(spark, d).select("hour_begin", X.null_flag("event_name").alias("has_event"))


@register("x14_null_to_zero", with_views(
    "SELECT hour_begin, fact_id, coalesce(injured, 0) AS injured, coalesce(killed, 0) AS killed FROM hwc_h",
    "hwc_h"))
def x14_null_to_zero(spark, d):
    return _hwc(spark, d).select("hour_begin", "fact_id", X.null_to_zero("injured").alias("injured"),
                                 X.null_to_zero("killed").alias("killed"))


@register("x15_label_any_match", with_views("SELECT hour_begin, fact_id, has_accident FROM hwc_h", "hwc_h"))
def x15_label_any_match(spark, d):
    return _hwc(spark, d).select("hour_begin", "fact_id", X.label_any_match("casualties").alias("has_accident"))


@register("x16_label_positive", with_views(
    "SELECT hour_begin, fact_id, CASE WHEN coalesce(injured, 0) + coalesce(killed, 0) = 0 THEN 0 ELSE 1 END "
    "AS has_casualty FROM hwc_h", "hwc_h"))
def x16_label_positive(spark, d):
    cas = X.null_to_zero("injured") + X.null_to_zero("killed")
    return _hwc(spark, d).select("hour_begin", "fact_id", X.label_positive(cas).alias("has_casualty"))


@register("x17_min_max_scale", with_views("""
SELECT hour_begin,
       CASE WHEN tmax = tmin THEN NULL ELSE (temperature - tmin) / (tmax - tmin) END AS temperature_norm,
       CASE WHEN pmax = pmin THEN NULL ELSE (CAST(pedestrians AS DOUBLE) - pmin) / (pmax - pmin) END AS pedestrians_norm
FROM ctx_all, (SELECT min(temperature) AS tmin, max(temperature) AS tmax,
                    CAST(min(pedestrians) AS DOUBLE) AS pmin, CAST(max(pedestrians) AS DOUBLE) AS pmax FROM ctx_all) s""",
    "ctx_all"))
def x17_min_max_scale(spark, d):
    return S.min_max_scale(V.ctx_all(spark, d), ["temperature", "pedestrians"]).select(
        "hour_begin", "temperature_norm", "pedestrians_norm")


@register("x18_fixed_range_scale", with_views("""
SELECT hour_begin, fact_id, CAST(weather AS DOUBLE) / CAST(9 AS DOUBLE) AS weather_norm,
       (CAST(day AS DOUBLE) - CAST(1 AS DOUBLE)) / CAST(6 AS DOUBLE) AS day_norm,
       CAST(hour_group AS DOUBLE) / CAST(5 AS DOUBLE) AS hour_norm FROM hwc_h""", "hwc_h"))
def x18_fixed_range_scale(spark, d):
    return _hwc(spark, d).select("hour_begin", "fact_id",
                                 S.fixed_range_scale("weather", 0, 9).alias("weather_norm"),
                                 S.fixed_range_scale("day", 1, 7).alias("day_norm"),
                                 S.fixed_range_scale("hour_group", 0, 5).alias("hour_norm"))


@register("x19_max_scale", with_views(
    "SELECT hour_begin, CAST(pedestrians AS DOUBLE) / CAST(4330 AS DOUBLE) AS ped_norm FROM ctx_all", "ctx_all"))
def x19_max_scale(spark, d):
    return V.ctx_all(spark, d).select("hour_begin", S.max_scale("pedestrians", 4330).alias("ped_norm"))


_PICKED = f"(has_accident = 0 OR {hash_pick('sample_key', FS['fraction'], FS['seed'])})"
_BAL = f"weather_summary IS NOT NULL AND {_PICKED}"  # F5 first
BALANCED = {"bal": f"SELECT * FROM hwc_h WHERE {_BAL}"}


@register("x20_norm_params", with_views("""
SELECT 'temperature' AS variable, min(temperature) AS min, max(temperature) AS max FROM bal
UNION ALL SELECT 'precipitation', min(precipitation), max(precipitation) FROM bal
UNION ALL SELECT 'weather', CAST(0 AS DOUBLE), CAST(9 AS DOUBLE)
UNION ALL SELECT 'day', CAST(1 AS DOUBLE), CAST(7 AS DOUBLE)
UNION ALL SELECT 'hour', CAST(0 AS DOUBLE), CAST(5 AS DOUBLE)
UNION ALL SELECT 'pedestrians', CAST(min(pedestrians) AS DOUBLE), CAST(max(pedestrians) AS DOUBLE) FROM bal""",
    "hwc_h", extra=BALANCED))
def x20_norm_params(spark, d):
    return Q.training_norm_params(V.ctx_h(spark, d), V.facts_h(spark, d))


@register("x21_fraction", with_views(
    "SELECT zip_code, CAST(sum(killed) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS frac_killed "
    "FROM facts_all GROUP BY zip_code", "facts_all"))
def x21_fraction(spark, d):
    g = V.facts_all(spark, d).groupBy("zip_code").agg(F.sum("killed").alias("k"), F.count(F.lit(1)).alias("n"))
    return g.select("zip_code", X.fraction("k", "n").alias("frac_killed"))


# =============================================================================
# Joins (K1-K4)
# =============================================================================

@register("k1_context_left_facts", with_views(
    "SELECT c.*, f.* FROM ctx_h c LEFT JOIN facts_h f ON c.hour_begin = f.fact_hour", "ctx_h", "facts_h"))
def k1_context_left_facts(spark, d):
    return K.context_left_facts(V.ctx_h(spark, d), V.facts_h(spark, d), "hour_begin", "fact_hour")


@register("k1_context_left_facts_daily", with_views(
    "SELECT c.*, f.* FROM ctx_d c LEFT JOIN facts_d f ON c.day_begin = f.fact_day", "ctx_d", "facts_d"))
def k1_context_left_facts_daily(spark, d):
    return K.context_left_facts(V.ctx_d(spark, d), V.facts_d(spark, d), "day_begin", "fact_day")


@register("k2_facts_left_context", with_views(K2_RAW, "facts_h", "ctx_h"))
def k2_facts_left_context(spark, d):
    return K.facts_left_context(V.facts_h(spark, d), V.ctx_h(spark, d), "fact_hour", "hour_begin",
                                drop_null=["weather_summary"])


@register("k2_facts_left_context_salted", with_views(K2_RAW, "facts_h", "ctx_h"))
def k2_facts_left_context_salted(spark, d):
    """K2 on the no-broadcast path with explicit salting (8 salts)."""
    return K.facts_left_context(V.facts_h(spark, d), V.ctx_h(spark, d), "fact_hour", "hour_begin",
                                drop_null=["weather_summary"], broadcast=False, salt=8)


@register("k3_facts_inner_context", with_views(
    "SELECT f.*, c.* FROM facts_h f JOIN ctx_h c ON f.fact_hour = c.hour_begin", "facts_h", "ctx_h"))
def k3_facts_inner_context(spark, d):
    return K.facts_inner_context(V.facts_h(spark, d), V.ctx_h(spark, d), "fact_hour", "hour_begin")


@register("k4_anti_join", with_views(
    "SELECT * FROM ctx_h c WHERE NOT EXISTS (SELECT 1 FROM facts_h f WHERE f.fact_hour = c.hour_begin)",
    "ctx_h", "facts_h"))
def k4_anti_join(spark, d):
    return K.anti_join(V.ctx_h(spark, d), V.facts_h(spark, d), "hour_begin", "fact_hour")


# =============================================================================
# Aggregations
# =============================================================================

@register("a1_factor_share", _a1_sql_raw())
def a1_factor_share(spark, d):
    return _a1_hourly(spark, d)


@register("a2_casualties_by_weather_factor", with_views("""
SELECT weather_summary AS weather, factor, CAST(sum(injured) AS BIGINT) AS injured,
       CAST(sum(killed) AS BIGINT) AS killed, CAST(sum(injured + killed) AS BIGINT) AS casualties
FROM k2 GROUP BY weather_summary, factor""", "facts_h", "ctx_h", extra={"k2": K2_RAW}))
def a2_casualties_by_weather_factor(spark, d):
    joined = K.facts_left_context(V.facts_h(spark, d), V.ctx_h(spark, d), "fact_hour", "hour_begin",
                                  drop_null=["weather_summary"])
    return A.casualties_by_weather_factor(joined)


def _batches(spark, d):
    """The hourly joined rows in four batches, as they would arrive, merged into the stored sums."""
    root = scratch_path(spark, "factor-sums")
    ctx = materialize(V.ctx_h(spark, d), "batch-context")
    for batch in range(4):
        facts = V.facts_h(spark, d).filter(F.col("fact_id") % 4 == batch)
        joined = K.facts_left_context(facts, ctx, "fact_hour", "hour_begin", drop_null=["weather_summary"])
        state = A.update_partials(spark, root, batch, joined)
    return state


@register("a1_share_batch_by_batch", _a1_sql_raw())
def a1_share_batch_by_batch(spark, d):
    """A1 kept up to date: four batches merged give the shares of all rows at once."""
    return A.shares_of_partials(_batches(spark, d))


@register("a2_casualties_batch_by_batch", with_views("""
SELECT weather_summary AS weather, factor, CAST(sum(injured) AS BIGINT) AS injured,
       CAST(sum(killed) AS BIGINT) AS killed, CAST(sum(injured + killed) AS BIGINT) AS casualties
FROM k2 GROUP BY weather_summary, factor""", "facts_h", "ctx_h", extra={"k2": K2_RAW}))
def a2_casualties_batch_by_batch(spark, d):
    """A2 kept up to date."""
    return A.casualties_of_partials(_batches(spark, d))


@register("a3_count_where", with_views(
    "SELECT count(*) FILTER (WHERE injured > 2) AS n FROM facts_d", "facts_d"))
def a3_count_where(spark, d):
    return A.count_where(V.facts_d(spark, d), F.col("injured") > 2)


@register("a4_global_agg", with_views(
    "SELECT CAST(sum(injured) AS BIGINT) AS injured, CAST(sum(killed) AS BIGINT) AS killed, "
    "count(*) AS n, min(crash_ts) AS first_ts, max(crash_ts) AS last_ts FROM facts_d", "facts_d"))
def a4_global_agg(spark, d):
    return A.global_agg(V.facts_d(spark, d), F.sum("injured").alias("injured"), F.sum("killed").alias("killed"),
                        F.count(F.lit(1)).alias("n"), F.min("crash_ts").alias("first_ts"),
                        F.max("crash_ts").alias("last_ts"))


@register("a5_event_rate_by_bucket", with_views(
    "SELECT hour_group, count(*) AS n_rows, count(*) FILTER (WHERE casualties > 0) AS n_event, "
    "CAST(count(*) FILTER (WHERE casualties > 0) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS rate "
    "FROM hwc_h GROUP BY hour_group", "hwc_h"))
def a5_event_rate_by_bucket(spark, d):
    return A.event_rate_by_bucket(_hwc(spark, d), "hour_group", F.col("casualties") > 0)


@register("a6_count_by_class_and_bucket", with_views(
    "SELECT weather, count(*) AS count FROM hwc_h WHERE has_accident = 1 GROUP BY weather", "hwc_h"))
def a6_count_by_class_and_bucket(spark, d):
    return A.count_by_class_and_bucket(_hwc(spark, d), "has_accident", 1, "weather")


def _rule_pred(t: DataFrame) -> DataFrame:
    """A fixed rule in place of a fitted model, so the scores can be checked in SQL."""
    return t.select("sample_key", F.col("has_accident").cast("double").alias("label"),
                    F.when(F.col("pedestrians_norm") > 0.5, 1.0).otherwise(0.0).alias("prediction"))


Q3_BODY = """
SELECT sample_key,
       CASE WHEN tmax = tmin THEN NULL ELSE (temperature - tmin) / (tmax - tmin) END AS temperature_norm,
       CASE WHEN rmax = rmin THEN NULL ELSE (precipitation - rmin) / (rmax - rmin) END AS precipitation_norm,
       (CAST(weather AS DOUBLE) - CAST(0 AS DOUBLE)) / CAST(9 AS DOUBLE) AS weather_norm,
       (CAST(day AS DOUBLE) - CAST(1 AS DOUBLE)) / CAST(6 AS DOUBLE) AS day_norm,
       (CAST(hour_group AS DOUBLE) - CAST(0 AS DOUBLE)) / CAST(5 AS DOUBLE) AS hour_norm,
       CASE WHEN pmax = pmin THEN NULL ELSE (CAST(pedestrians AS DOUBLE) - pmin) / (pmax - pmin) END AS pedestrians_norm,
       has_accident
FROM bal, (SELECT min(temperature) AS tmin, max(temperature) AS tmax, min(precipitation) AS rmin,
                  max(precipitation) AS rmax, CAST(min(pedestrians) AS DOUBLE) AS pmin,
                  CAST(max(pedestrians) AS DOUBLE) AS pmax FROM bal) s"""
TRAINING = dict(BALANCED, training=Q3_BODY)
RULE = ("SELECT sample_key, CAST(has_accident AS DOUBLE) AS label, "
        "CASE WHEN pedestrians_norm > 0.5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction "
        "FROM training")


@register("a7_prediction_counts", with_views(
    "SELECT prediction, count(*) AS count FROM pred GROUP BY prediction", "hwc_h",
    extra=dict(TRAINING, pred=RULE)))
def a7_prediction_counts(spark, d):
    return A.prediction_counts(_rule_pred(_training(spark, d)))


# =============================================================================
# Sort, limit, set operations
# =============================================================================

@register("t1_sort_desc", with_views("""
SELECT weather_summary AS weather, factor, CAST(sum(injured) AS BIGINT) AS injured,
       CAST(sum(killed) AS BIGINT) AS killed, CAST(sum(injured + killed) AS BIGINT) AS casualties
FROM cw_h GROUP BY weather_summary, factor ORDER BY casualties DESC NULLS LAST, weather, factor""", "cw_h"))
def t1_sort_desc(spark, d):
    return O.sort_desc(Q.factor_casualties(V.facts_h(spark, d), V.ctx_h(spark, d)), "casualties",
                       ("weather", "factor"))


@register("t2_top_n", _q5_sql(tail="ORDER BY frac DESC NULLS LAST, weather, factor LIMIT 5"))
def t2_top_n(spark, d):
    return O.top_n(_q5(spark, d), "frac", 5, ("weather", "factor"))


@register("t2_latest_hours", with_views("SELECT hour_begin FROM ctx_all ORDER BY hour_begin DESC LIMIT 5", "ctx_all"))
def t2_latest_hours(spark, d):
    """T2 as the source uses it: the five latest context hours (hours are unique)."""
    return O.top_n(V.ctx_all(spark, d).select("hour_begin"), "hour_begin", 5)


@register("t3_head", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem "
                     "ORDER BY l_orderkey, l_linenumber, l_quantity LIMIT 10")
def t3_head(spark, d):
    # (l_orderkey, l_linenumber) repeats in the larger tables: order by every output
    # column so the first 10 rows are one well-defined answer.
    li = V.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return O.head(li, 10, ["l_orderkey", "l_linenumber", "l_quantity"])


@register("t4_top_factors", _q5_sql(
    tail="WHERE weather = 'clear-day' AND factor <> 'Unspecified' ORDER BY frac DESC, weather, factor"))
def t4_top_factors(spark, d):
    return O.top_factors(_q5(spark, d), weather="clear-day")


@register("t4_top_factors_each_weather", _q5_sql(
    "cw_d", tail="QUALIFY row_number() OVER (PARTITION BY weather ORDER BY frac DESC, factor) <= 2"))
def t4_top_factors_each_weather(spark, d):
    """T4 for all weathers at once: the two largest shares of each."""
    shares = Q.factor_share(V.facts_d(spark, d), V.ctx_d(spark, d), Q.DAILY)
    return O.top_per_group(shares, "weather", "frac", 2, ("factor",)).drop("rank")


_TOP_SQL = """
SELECT factor, fact_id, injured, CAST(row_number() OVER (PARTITION BY factor ORDER BY injured DESC, fact_id) AS INTEGER) AS rank
FROM {src} QUALIFY rank <= {n}"""


@register("t4_worst_crashes_each_factor", with_views(_TOP_SQL.format(src="facts_d", n=10), "facts_d"))
def t4_worst_crashes_each_factor(spark, d):
    """T4 over all rows: ten crashes of every factor; a few factors hold all line items."""
    return O.top_per_group(V.facts_d(spark, d).select("factor", "fact_id", "injured"), "factor", "injured", 10, ("fact_id",))


@register("t4_worst_crashes_salted", with_views(_TOP_SQL.format(src="facts_d", n=1500), "facts_d"))
def t4_worst_crashes_salted(spark, d):
    """T4 with more rows per group than Spark limits by itself: ranked in parts first."""
    return O.top_per_group(V.facts_d(spark, d).select("factor", "fact_id", "injured"), "factor", "injured", 1500, ("fact_id",),
                           salt=8)


@register("t5_sort_lines", with_views("SELECT value FROM crash_lines ORDER BY value", "crash_lines"))
def t5_sort_lines(spark, d):
    return O.sort_lines(V.crash_lines(spark, d).select("value"))


@register("u1_union_all", with_views(
    "SELECT fact_id, factor FROM facts_all UNION ALL SELECT fact_id, factor FROM facts_d", "facts_all", "facts_d"))
def u1_union_all(spark, d):
    return O.union_all(V.facts_all(spark, d).select("fact_id", "factor"),
                       V.facts_d(spark, d).select("fact_id", "factor"))


@register("u2_distinct", with_views("SELECT DISTINCT factor, zip_code FROM facts_d", "facts_d"))
def u2_distinct(spark, d):
    return O.distinct(V.facts_d(spark, d).select("factor", "zip_code"))


# =============================================================================
# Sampling (B1-B4)
# =============================================================================

@register("b1_bernoulli_sample")
def b1_bernoulli_sample(spark, d):
    return B.bernoulli_sample(V.facts_d(spark, d).select("fact_id", "factor"), 0.3, 123)


@register("b2_hash_sample", with_views(
    f"SELECT fact_id, factor FROM facts_d WHERE {hash_pick('fact_id', 0.3, 123)}", "facts_d"))
def b2_hash_sample(spark, d):
    return B.hash_sample(V.facts_d(spark, d).select("fact_id", "factor"), "fact_id", 0.3, 123)


@register("b3_balance_classes", with_views(
    f"SELECT sample_key, has_accident FROM hwc_h WHERE {_PICKED}", "hwc_h"))
def b3_balance_classes(spark, d):
    return B.balance_classes(_hwc(spark, d), "has_accident", keep=0, key="sample_key",
                             **FS).select("sample_key", "has_accident")


def _to_sizes_sql(src: str, label: str, target: str) -> str:
    """Rows of a class in hash order, while all rows of their hash still fit its size."""
    return f"""
SELECT * EXCLUDE (b, upto, target) FROM (
  SELECT *, count(*) OVER (PARTITION BY {label} ORDER BY b RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM {src}) t
WHERE upto <= target"""


@register("b3_balance_to_smallest", with_views(_to_sizes_sql("s", "has_accident", "target"), "hwc_h", extra={
    "h": f"SELECT sample_key, has_accident, {hash_bucket('sample_key', FS['seed'])} AS b FROM hwc_h",
    "s": "SELECT *, (SELECT min(n) FROM (SELECT count(*) AS n FROM h GROUP BY has_accident) c) AS target FROM h"}))
def b3_balance_to_smallest(spark, d):
    """Every class cut to the exact size of the smallest, in place of a fraction tuned by hand."""
    rows = _hwc(spark, d).select("sample_key", "has_accident")
    return B.balance_to_sizes(rows, "has_accident", FS["seed"], "sample_key")


@register("b3_balance_to_sizes", with_views(_to_sizes_sql("s", "factor", "target"), "facts_d", extra={
    "s": f"SELECT fact_id, factor, {hash_bucket('fact_id', 5)} AS b, CASE factor WHEN 'AF' THEN 1000 WHEN 'RF' THEN 77 "
         "ELSE 1000000000000 END AS target FROM facts_d"}))
def b3_balance_to_sizes(spark, d):
    """B3 to sizes per class over all line items; classes without one stay whole."""
    rows = V.facts_d(spark, d).select("fact_id", "factor")
    return B.balance_to_sizes(rows, "factor", 5, "fact_id", {"AF": 1000, "RF": 77})


@register("b4_train_test_split")
def b4_train_test_split(spark, d):
    train, _ = B.train_test_split(V.facts_d(spark, d).select("fact_id", "factor"), (0.7, 0.3), 1823)
    return train


@register("b4_hash_split", with_views(
    f"SELECT fact_id, factor FROM facts_d WHERE {split_pick('fact_id', 0.7, 1823)}", "facts_d"))
def b4_hash_split(spark, d):
    train, _ = B.train_test_split(V.facts_d(spark, d).select("fact_id", "factor"), (0.7, 0.3), 1823,
                                  key="fact_id", method="md5")
    return train


def _facts_some_keys(spark, d) -> DataFrame:
    """fact_id, injured, factor with every fifth key missing."""
    f = V.facts_d(spark, d)
    return f.select(F.when(F.col("fact_id") % 5 != 0, F.col("fact_id")).alias("fact_id"), "injured", "factor")


_SOME_KEYS = ("SELECT CASE WHEN fact_id % 5 <> 0 THEN fact_id END AS fact_id, injured, factor FROM facts_d")
_SOME_KEY = row_key("fact_id", "fact_id", "injured", "factor")


@register("b2_hash_sample_null_keys", with_views(
    f"SELECT fact_id, injured, factor FROM s WHERE {hash_pick(_SOME_KEY, 0.3, 123)}", "facts_d", extra={"s": _SOME_KEYS}))
def b2_hash_sample_null_keys(spark, d):
    """Rows without a key are sampled on the whole row."""
    return B.hash_sample(_facts_some_keys(spark, d), "fact_id", 0.3, 123)


@register("b4_split_null_keys", with_views(f"""
SELECT factor, count(*) FILTER (WHERE {split_pick(_SOME_KEY, 0.7, 1823)}) AS n_train,
       count(*) FILTER (WHERE NOT {split_pick(_SOME_KEY, 0.7, 1823)}) AS n_test, count(*) AS n_rows
FROM s GROUP BY factor""", "facts_d", extra={"s": _SOME_KEYS}))
def b4_split_null_keys(spark, d):
    """The parts of a split add up to the input, rows without a key included."""
    rows = _facts_some_keys(spark, d)
    train, test = B.train_test_split(rows, (0.7, 0.3), 1823, key="fact_id", method="md5")
    parts = train.select("factor", F.lit("train").alias("part")).unionByName(
        test.select("factor", F.lit("test").alias("part"))).unionByName(rows.select("factor", F.lit("all").alias("part")))
    return parts.groupBy("factor").agg(F.count_if(F.col("part") == "train").alias("n_train"),
                                       F.count_if(F.col("part") == "test").alias("n_test"),
                                       F.count_if(F.col("part") == "all").alias("n_rows"))


@register("b4_balance_then_split", with_views(f"""
SELECT killed, {split_pick('fact_id', 0.7, 1823)} AS in_train, count(*) AS n_rows
FROM facts_d WHERE killed = 1 OR {hash_pick('fact_id', 0.1, 1823)} GROUP BY ALL""", "facts_d"))
def b4_balance_then_split(spark, d):
    """Balancing and then splitting on one key and seed: both classes in both parts."""
    rows = B.balance_classes(V.facts_d(spark, d), "killed", keep=1, fraction=0.1, seed=1823, key="fact_id")
    train, test = B.train_test_split(rows, (0.7, 0.3), 1823, key="fact_id", method="md5")
    parts = train.withColumn("in_train", F.lit(True)).unionByName(test.withColumn("in_train", F.lit(False)))
    return parts.groupBy("killed", "in_train").agg(F.count(F.lit(1)).alias("n_rows"))


@register("b1_native_sample_flags", with_views(
    "SELECT count(*) AS n_rows, TRUE AS is_subset, TRUE AS near_fraction FROM facts_d", "facts_d"))
def b1_native_sample_flags(spark, d):
    """B1 over all rows: the sample is a subset, each row at most once, within 5 standard deviations of
    the fraction."""
    rows = V.facts_d(spark, d).select("fact_id", "factor").withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "b1-rows")
    return _part_flags(rows, B.bernoulli_sample(rows, 0.3, 123), 0.3, "near_fraction")


def _part_flags(rows: DataFrame, part: DataFrame, fraction: float, name: str) -> DataFrame:
    part = part.select("row", F.lit(1).alias("hit")).groupBy("row").agg(F.sum("hit").alias("hits"))
    joined = rows.join(part, "row", "full_outer")
    n, k = F.count("factor"), F.sum(F.coalesce("hits", F.lit(0)))
    near = F.abs(k - n * fraction) <= 5 * F.sqrt(n * fraction * (1 - fraction))
    one = (F.coalesce(F.max("hits"), F.lit(0)) <= 1) & (F.count_if(F.col("factor").isNull()) == 0)
    return joined.agg(n.alias("n_rows"), one.alias("is_subset"), near.alias(name))


@register("b4_native_split_flags", with_views(
    "SELECT count(*) AS n_rows, TRUE AS parts_add_up, TRUE AS near_fraction FROM facts_d", "facts_d"))
def b4_native_split_flags(spark, d):
    """Native B4 over all rows: disjoint parts that add up to the input, sizes near the weights."""
    rows = V.facts_d(spark, d).select("fact_id", "factor").withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "b4-rows")
    train, test = B.train_test_split(rows, (0.7, 0.3), 1823)
    train = materialize(train.withColumn("t", F.lit(1)), "b4-train")
    test = materialize(test.withColumn("t", F.lit(0)), "b4-test")
    parts = train.unionByName(test).groupBy("row").agg(F.count(F.lit(1)).alias("c"), F.sum("t").alias("t"))
    n, k = F.count("factor"), F.sum(F.coalesce("t", F.lit(0)))
    near = F.abs(k - n * 0.7) <= 5 * F.sqrt(n * 0.7 * 0.3)
    whole = (F.min(F.coalesce("c", F.lit(0))) == 1) & (F.max(F.coalesce("c", F.lit(0))) == 1)
    return rows.join(parts, "row", "left").agg(n.alias("n_rows"), whole.alias("parts_add_up"), near.alias("near_fraction"))


# =============================================================================
# Models and statistics
# =============================================================================

@register("m1_assemble")
def m1_assemble(spark, d):
    from pyspark.ml.functions import vector_to_array
    out = M.assemble(_training(spark, d), list(Q.FINAL_FEATURES), handle_invalid="keep")
    return out.select("sample_key", vector_to_array("features").alias("features"))


@register("m2_index_label", with_views(
    "SELECT sample_key, CAST(has_accident AS DOUBLE) AS label FROM training", "hwc_h", extra=TRAINING))
def m2_index_label(spark, d):
    return M.index_label(_training(spark, d), "has_accident").select("sample_key", "label")


def _final_parts(spark, d) -> list[DataFrame]:
    return Q.split(Q.model_input(_training(spark, d), Q.FINAL_FEATURES, "m-input"), Q.FINAL_SPLIT_SEED)


def _fit_rows(spark, d, kind: str):
    train, test = _final_parts(spark, d)
    if kind == "multinomial":
        model = M.fit_multinomial(train, max_iter=100)
        return _rows(spark, M.coefficient_matrix(model, list(Q.FINAL_FEATURES)),
                     "class int, term string, value double")
    if kind == "naive_bayes":
        return A.prediction_counts(M.score(M.fit_naive_bayes(train), test))
    model = M.fit_logistic(train, max_iter=100)
    if kind == "coefficients":
        return _rows(spark, M.coefficients(model, list(Q.FINAL_FEATURES)), TERM_SCHEMA)
    if kind == "score":
        return M.score(model, test).select("label", "prediction")
    rows = [("logistic", "auc_hard_test", M.eval_auc(M.score(model, test))),
            ("logistic", "iterations", float(model.summary.totalIterations))]
    return _rows(spark, rows, METRIC_SCHEMA)


@register("m3_fit_logistic")
def m3_fit_logistic(spark, d):
    return _fit_rows(spark, d, "logistic")


@register("m4_fit_multinomial")
def m4_fit_multinomial(spark, d):
    return _fit_rows(spark, d, "multinomial")


@register("m5_fit_naive_bayes")
def m5_fit_naive_bayes(spark, d):
    return _fit_rows(spark, d, "naive_bayes")


def _area_labelled(spark, d) -> DataFrame:
    checkpoint_root(spark)
    data = Q.area_dataset(V.ctx_h(spark, d), V.facts_h(spark, d), AREA_ZIP)
    return M.assemble(data, list(Q.AREA_FEATURES))


def _area_parts(spark, d) -> list[DataFrame]:
    data = materialize(_area_labelled(spark, d).select("sample_key", "features", "has_accident"), "rf-input")
    return Q.split(data, Q.AREA_SPLIT_SEED)


@register("m6_fit_random_forest")
def m6_fit_random_forest(spark, d):
    train, test = _area_parts(spark, d)
    model = M.fit_random_forest(train, "has_accident")
    return A.prediction_counts(M.score(model, test), "predictedLabel")


_AREA_BAL = (f"SELECT * FROM hwc_area WHERE weather_summary IS NOT NULL AND (has_accident = 1 OR "
             f"{hash_pick('sample_key', Q.AREA_SAMPLE['fraction'], Q.AREA_SAMPLE['seed'])})")
_AREA_FEAT = "SELECT " + ", ".join(Q.AREA_FEATURES) + " FROM area_bal"


@register("m7_index_features", with_views(
    "SELECT feature_index, n_categories FROM ("
    + " UNION ALL ".join(f"SELECT {i} AS feature_index, CAST(count(DISTINCT CAST({c} AS DOUBLE)) AS INTEGER) "
                         f"AS n_categories FROM area_feat" for i, c in enumerate(Q.AREA_FEATURES))
    + ") t WHERE n_categories <= 10", "hwc_area", extra={"area_bal": _AREA_BAL, "area_feat": _AREA_FEAT}))
def m7_index_features(spark, d):
    model = M.index_features(_area_labelled(spark, d), max_categories=10)
    rows = [(int(i), len(m)) for i, m in sorted(model.categoryMaps.items())]
    return _rows(spark, rows, "feature_index int, n_categories int")


@register("m8_label_to_string", with_views(
    "SELECT sample_key, CASE WHEN prediction = 1 THEN '1' ELSE '0' END AS predictedLabel FROM pred",
    "hwc_h", extra=dict(TRAINING, pred=RULE)))
def m8_label_to_string(spark, d):
    pred = _rule_pred(_training(spark, d))
    return M.label_to_string(pred, ["0", "1"]).select("sample_key", "predictedLabel")


@register("m9_auc_hard", with_views("""
SELECT ((CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE)
         / NULLIF(CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE), 0))
      + (CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS DOUBLE)
         / NULLIF(CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE), 0))) / CAST(2 AS DOUBLE) AS auc_hard
FROM pred""", "hwc_h", extra=dict(TRAINING, pred=RULE)))
def m9_auc_hard(spark, d):
    return M.auc_hard(_rule_pred(_training(spark, d)))


_RAW_SCORE = "floor(1000 * ({0} - {1} / 2 + {2}))"
_RAW_SQL = "CAST(" + _RAW_SCORE.format("temperature_norm", "pedestrians_norm", "hour_norm") + " AS DOUBLE)"


def _auc_ranks_sql(rows: str) -> str:
    """The rank sum in SQL: mean ranks of tied scores, all rows in one window."""
    return f"""
SELECT n_pos, n_neg, round((r - n_pos * (n_pos + 1) / 2) / (CAST(n_pos AS DOUBLE) * n_neg), 9) AS auc
FROM (SELECT CAST(count(*) FILTER (WHERE y = 1) AS BIGINT) AS n_pos, CAST(count(*) FILTER (WHERE y = 0) AS BIGINT) AS n_neg,
             sum(k) FILTER (WHERE y = 1) AS r
      FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS k FROM ({rows}) a) b) c"""


@register("m9_auc_raw", with_views(_auc_ranks_sql(f"SELECT has_accident AS y, {_RAW_SQL} AS s FROM training"),
                                   "hwc_h", extra=TRAINING))
def m9_auc_raw(spark, d):
    """M9 on raw scores: exact area under ROC by ranks."""
    score = F.floor(1000 * (F.col("temperature_norm") - F.col("pedestrians_norm") / 2 + F.col("hour_norm"))).cast("double")
    rows = _training(spark, d).select(F.col("has_accident").alias("label"), score.alias("score"))
    return M.auc_ranks(rows, "score").withColumn("auc", F.round("auc", 9))


_DAILY_SCORE = "({0} * 7919) % 20011 + 4000 * killed"


@register("m9_auc_raw_daily", with_views(_auc_ranks_sql(
    f"SELECT killed AS y, CAST({_DAILY_SCORE.format('fact_id')} AS DOUBLE) AS s FROM facts_d"), "facts_d"))
def m9_auc_raw_daily(spark, d):
    """M9 by ranks over all line items: more distinct scores than an evaluator keeps, with ties."""
    rows = V.facts_d(spark, d).selectExpr("killed AS label", f"CAST({_DAILY_SCORE.format('fact_id')} AS DOUBLE) AS score")
    return M.auc_ranks(rows, "score").withColumn("auc", F.round("auc", 9))


@register("m9_score_ranks", with_views(f"""
SELECT s AS score, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg,
       CAST(coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS neg_below
FROM (SELECT CAST({_DAILY_SCORE.format('fact_id')} AS DOUBLE) AS s, count(*) FILTER (WHERE killed = 1) AS pos,
             count(*) FILTER (WHERE killed = 0) AS neg FROM facts_d GROUP BY 1) a""", "facts_d"))
def m9_score_ranks(spark, d):
    """The ROC curve behind M9: negatives below every distinct score."""
    rows = V.facts_d(spark, d).selectExpr("killed AS label", f"CAST({_DAILY_SCORE.format('fact_id')} AS DOUBLE) AS score")
    return M.score_ranks(rows, "score")


@register("m10_accuracy", with_views(
    "SELECT avg(CASE WHEN label = prediction THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS accuracy "
    "FROM pred", "hwc_h", extra=dict(TRAINING, pred=RULE)))
def m10_accuracy(spark, d):
    return M.accuracy(_rule_pred(_training(spark, d)))


@register("m11_coefficients")
def m11_coefficients(spark, d):
    return _fit_rows(spark, d, "coefficients")


@register("m12_score")
def m12_score(spark, d):
    return _fit_rows(spark, d, "score")


# --- results of fitted models as flags over all rows ------------------------------------

_FEATURES_SQL = ", ".join(f"CAST({c} AS DOUBLE)" for c in Q.FINAL_FEATURES)


@register("m1_assembled_values", with_views(
    f"SELECT sample_key, round(list_sum([{_FEATURES_SQL}]), 6) AS total, len([{_FEATURES_SQL}]) AS n FROM training",
    "hwc_h", extra=TRAINING))
def m1_assembled_values(spark, d):
    """M1: number and sum of the assembled values of every row (no row skipped)."""
    from pyspark.ml.functions import vector_to_array
    v = vector_to_array("features")
    total = F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    return M.assemble(_training(spark, d), list(Q.FINAL_FEATURES)).select(
        "sample_key", r6(total).alias("total"), F.size(v).cast("bigint").alias("n"))


_SPLIT_SQL = """
SELECT count(*) FILTER (WHERE {pick}) AS n_train, count(*) FILTER (WHERE NOT {pick}) AS n_test, {rest} FROM {src}"""


def _sizes(train: DataFrame, test: DataFrame, *flags) -> DataFrame:
    both = train.select(F.lit(1).alias("t")).unionByName(test.select(F.lit(0).alias("t")))
    return both.agg(F.count_if(F.col("t") == 1).alias("n_train"), F.count_if(F.col("t") == 0).alias("n_test"), *flags)


def _flag(value: bool, name: str):
    return F.lit(bool(value)).alias(name)


def _both_classes(rows: DataFrame, label: str = "label") -> bool:
    """A fit on one class proves nothing: the flags of models also ask for two."""
    r = rows.agg(F.min(label).alias("lo"), F.max(label).alias("hi")).first()
    return r["lo"] is not None and r["lo"] != r["hi"]


def _penalised_gradient(model, train: DataFrame, n_features: int) -> float:
    """Largest derivative of the penalised logistic loss (weights by standard deviation, as fitted) at the
    model's coefficients: 0 at the optimum. One aggregate over the training rows."""
    from pyspark.ml.functions import vector_to_array
    rows = train.select(vector_to_array("features").alias("x"), "label")
    coefs, intercept = model.coefficients.toArray().tolist(), float(model.intercept)
    z = F.lit(intercept)
    for i, c in enumerate(coefs):
        z = z + F.col("x")[i] * c
    err = 1 / (1 + F.exp(-z)) - F.col("label")
    aggs = [F.avg(err).alias("g")] + [F.avg(err * F.col("x")[i]).alias(f"g{i}") for i in range(n_features)]
    aggs += [F.stddev_samp(F.col("x")[i]).alias(f"s{i}") for i in range(n_features)]
    r = rows.agg(*aggs).first()
    reg = model.getOrDefault("regParam")
    worst = abs(r["g"])
    for i, c in enumerate(coefs):
        s = r[f"s{i}"] or 0.0
        if s > 0:
            ridge = reg * (1 - model.getOrDefault("elasticNetParam")) * c * s
            lasso = reg * model.getOrDefault("elasticNetParam")
            g = r[f"g{i}"] / s + ridge
            worst = max(worst, abs(g + lasso * (1 if c > 0 else -1)) if c else max(0.0, abs(g) - lasso))
    return worst


@register("m3_logistic_optimum", with_views(_SPLIT_SQL.format(
    pick=split_pick("sample_key", 0.7, Q.FINAL_SPLIT_SEED), rest="TRUE AS is_optimal", src="training"),
    "hwc_h", extra=TRAINING))
def m3_logistic_optimum(spark, d):
    """M3: the fitted coefficients are an optimum of the penalised loss over the training rows."""
    train, test = _final_parts(spark, d)
    model = M.fit_logistic(train, max_iter=500)
    return _sizes(train, test, _flag(
        _both_classes(train) and _penalised_gradient(model, train, len(Q.FINAL_FEATURES)) < 0.01, "is_optimal"))


@register("m4_multinomial_probabilities", with_views(_SPLIT_SQL.format(
    pick=split_pick("sample_key", 0.7, Q.FINAL_SPLIT_SEED), rest="TRUE AS softmax_agrees", src="training"),
    "hwc_h", extra=TRAINING))
def m4_multinomial_probabilities(spark, d):
    """M4: probabilities of every row are the softmax of the reported coefficient matrix."""
    from pyspark.ml.functions import vector_to_array
    train, test = _final_parts(spark, d)
    model = M.fit_multinomial(train, max_iter=100)
    terms = M.coefficient_matrix(model, list(Q.FINAL_FEATURES))
    z = {}
    for k in sorted({c for c, _, _ in terms}):
        values = dict((t, v) for c, t, v in terms if c == k)
        z[k] = F.lit(min(max(values["intercept"], -1e300), 1e300))  # infinite where a class is missing
        for i, name in enumerate(Q.FINAL_FEATURES):
            z[k] = z[k] + vector_to_array("features")[i] * values[name]
    top = F.greatest(*z.values()) if len(z) > 1 else z[0]
    norm = sum((F.exp(x - top) for x in z.values()), F.lit(0.0))
    rows = M.score(model, train.unionByName(test))
    gap = F.greatest(F.lit(0.0), *[F.abs(vector_to_array("probability")[k] - F.exp(x - top) / norm) for k, x in z.items()])
    worst = rows.agg(F.max(gap)).first()[0]
    return _sizes(train, test, _flag(_both_classes(train) and worst < 1e-9, "softmax_agrees"))


@register("m5_naive_bayes_closed_form", with_views(_SPLIT_SQL.format(
    pick=split_pick("sample_key", 0.7, Q.FINAL_SPLIT_SEED), rest="TRUE AS closed_form", src="training"),
    "hwc_h", extra=TRAINING))
def m5_naive_bayes_closed_form(spark, d):
    """M5: log priors and log likelihoods equal the smoothed sums of the training rows."""
    import math

    from pyspark.ml.functions import vector_to_array
    train, test = _final_parts(spark, d)
    model = M.fit_naive_bayes(train)
    k = len(Q.FINAL_FEATURES)
    sums = train.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(vector_to_array("features")[i]).alias(f"s{i}") for i in range(k)]).orderBy("label").collect()
    smooth, total, gap = model.getOrDefault("smoothing"), sum(r["n"] for r in sums), 0.0
    for c, r in enumerate(sums):
        mass = sum(r[f"s{i}"] for i in range(k)) + smooth * k
        gap = max(gap, abs(model.pi[c] - math.log((r["n"] + smooth) / (total + smooth * len(sums)))))
        gap = max([gap, *[abs(model.theta[c, i] - math.log((r[f"s{i}"] + smooth) / mass)) for i in range(k)]])
    return _sizes(train, test, _flag(_both_classes(train) and gap < 1e-9, "closed_form"))


@register("m6_forest_beats_majority", with_views(_SPLIT_SQL.format(
    pick=split_pick("sample_key", 0.7, Q.AREA_SPLIT_SEED), rest="TRUE AS not_below_majority", src="area_bal"),
    "hwc_area", extra={"area_bal": _AREA_BAL}))
def m6_forest_beats_majority(spark, d):
    """M6: on its training rows the forest is right at least as often as the larger class."""
    train, test = _area_parts(spark, d)
    pred = M.score(M.fit_random_forest(train, "has_accident"), train)
    both = _both_classes(train, "has_accident")
    r = pred.agg(F.avg((F.col("predictedLabel") == F.col("has_accident").cast("string")).cast("double")).alias("hit"),
                 F.avg(F.col("has_accident").cast("double")).alias("share")).first()
    return _sizes(train, test, _flag(both and r["hit"] >= max(r["share"], 1 - r["share"]) - 1e-9, "not_below_majority"))


@register("m6_forest_as_tables", with_views(_SPLIT_SQL.format(
    pick=split_pick("sample_key", 0.7, Q.AREA_SPLIT_SEED),
    rest="TRUE AS tables_agree, TRUE AS leaves_hold_shares", src="area_bal"), "hwc_area", extra={"area_bal": _AREA_BAL}))
def m6_forest_as_tables(spark, d):
    """M6: the trees as a node table; joins down the tree give every row the prediction and votes of the model."""
    from pyspark.ml.functions import vector_to_array
    train, test = _area_parts(spark, d)
    pipeline = M.fit_random_forest(train, "has_accident")
    forest = pipeline.stages[2]
    nodes = materialize(M.forest_nodes(forest, spark), "forest-nodes")
    rows = train.unionByName(test).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(M.score(pipeline, rows).select("row", "indexedFeatures", "prediction",
                                                      vector_to_array("rawPrediction").alias("raw")), "forest-rows")
    mine = M.score_forest(nodes, rows, "row").withColumnRenamed("prediction", "own")
    met = rows.join(mine, "row", "left")
    same = F.coalesce((F.col("own") == F.col("prediction")) & (F.abs(F.array_max("raw") - F.col("votes")) < 1e-9), F.lit(False))
    wrong = met.filter(~same).isEmpty()
    leaves = nodes.filter("feature IS NULL").agg(F.max(F.abs(F.aggregate("shares", F.lit(0.0), lambda s, x: s + x) - 1))).first()[0]
    return _sizes(train, test, _flag(wrong and _both_classes(train, "has_accident"), "tables_agree"),
                  _flag(leaves < 1e-9, "leaves_hold_shares"))


@register("m11_m12_scores_follow_coefficients", with_views(_SPLIT_SQL.format(
    pick=split_pick("sample_key", 0.7, Q.FINAL_SPLIT_SEED), rest="TRUE AS sigmoid_agrees", src="training"),
    "hwc_h", extra=TRAINING))
def m11_m12_scores_follow_coefficients(spark, d):
    """Scores of every row are the sigmoid of the reported coefficients."""
    from pyspark.ml.functions import vector_to_array
    train, test = _final_parts(spark, d)
    model = M.fit_logistic(train, max_iter=100)
    terms = dict(M.coefficients(model, list(Q.FINAL_FEATURES)))
    z = F.lit(terms["intercept"])
    for i, name in enumerate(Q.FINAL_FEATURES):
        z = z + vector_to_array("features")[i] * terms[name]
    p = 1 / (1 + F.exp(-z))
    rows = M.score(model, train.unionByName(test))
    wrong = rows.filter((F.abs(vector_to_array("probability")[1] - p) > 1e-9)
                        | (F.col("prediction") != (p > model.getThreshold()).cast("double")))
    return _sizes(train, test, _flag(_both_classes(train) and wrong.isEmpty(), "sigmoid_agrees"))


@register("s7_saved_model_equals_loaded", with_views(
    "SELECT count(*) AS n_rows, TRUE AS same_scores FROM training", "hwc_h", extra=TRAINING))
def s7_saved_model_equals_loaded(spark, d):
    """The loaded model gives every row the probability of the saved one."""
    from pyspark.ml.functions import vector_to_array
    data = Q.model_input(_training(spark, d), Q.FINAL_FEATURES, "s7-input")
    model = M.fit_logistic(data, max_iter=50)
    path = scratch_path(spark, "s7")
    io.save_model(model, path)
    loaded = io.load_model(path, "logistic")
    mine = M.score(model, data).select("features", vector_to_array("probability")[1].alias("p"))
    theirs = M.score(loaded, mine).select("p", vector_to_array("probability")[1].alias("q"))
    both = F.lit(_both_classes(data))
    return theirs.agg(F.count(F.lit(1)).alias("n_rows"), (both & (F.max(F.abs(F.col("p") - F.col("q"))) == 0)).alias("same_scores"))


@register("s7_stored_ranges_scale_new_rows", with_views("SELECT * FROM training", "hwc_h", extra=TRAINING))
def s7_stored_ranges_scale_new_rows(spark, d):
    """Ranges written with a model and read back scale rows as X17/X18 did."""
    sample = Q.training_sample(V.ctx_h(spark, d), V.facts_h(spark, d))
    path = scratch_path(spark, "ranges")
    Q.norm_params_of(sample).write.parquet(path)
    out = Q.scale_with(sample, spark.read.parquet(path))
    return out.select("sample_key", "temperature_norm", "precipitation_norm", "weather_norm", "day_norm", "hour_norm",
                      "pedestrians_norm", "has_accident")


# Fixed value: column order of the source's matrix.
_M13 = ["pedestrians", "temperature", "precipitation", "has_event", "hour_group", "day", "weather",
        "has_accident"]


def _m13_body(src: str, columns: list[str]) -> str:
    parts = []
    for i, a in enumerate(columns):
        for b in columns[i:]:
            # Undefined (a constant column) is NULL, as in the Spark operator.
            c = f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"
            expr = f"round(CASE WHEN isnan({c}) THEN NULL ELSE {c} END, 6)"
            parts.append(f"SELECT '{a}' AS var_a, '{b}' AS var_b, {expr} AS r FROM {src}")
            if a != b:
                parts.append(f"SELECT '{b}' AS var_a, '{a}' AS var_b, {expr} AS r FROM {src}")
    return " UNION ALL ".join(parts)


@register("m13_correlation_matrix", with_views(_m13_body("hwc_h", _M13), "hwc_h"))
def m13_correlation_matrix(spark, d):
    out = M.correlation_matrix(_hwc(spark, d), _M13)
    return out.withColumn("r", r6(F.col("r")))


_M14 = ["hour_group", "weather", "day", "has_event"]


def _m14_body(src: str, features: list[str], more: str = "") -> str:
    parts = []
    for f in features:
        parts.append(f"""
SELECT '{f}' AS feature, round(sum(CAST(o AS DOUBLE) * CAST(o AS DOUBLE) * CAST(n AS DOUBLE)
                                 / (CAST(r AS DOUBLE) * CAST(c AS DOUBLE))) - max(n), 6) AS statistic,
       CAST((count(DISTINCT v) - 1) * (count(DISTINCT y) - 1) AS INTEGER) AS dof{more}
FROM (SELECT v, y, o, sum(o) OVER (PARTITION BY v) AS r, sum(o) OVER (PARTITION BY y) AS c,
             sum(o) OVER () AS n
      FROM (SELECT CAST({f} AS DOUBLE) AS v, CAST(has_accident AS VARCHAR) AS y, count(*) AS o
            FROM {src} WHERE {f} IS NOT NULL GROUP BY 1, 2) cells) framed""")
    return " UNION ALL ".join(parts)


def _m14_sql() -> str:
    return with_views(_m14_body("hwc_h", _M14), "hwc_h")


@register("m14_chi_square", _m14_sql())
def m14_chi_square(spark, d):
    out = M.chi_square(_hwc(spark, d), _M14, "has_accident")
    return out.withColumn("statistic", r6(F.col("statistic")))


def _gamma_sql(cells: str, digits: int) -> str:
    """P-values by the plain series of the lower function, term by term."""
    a, x = "(CAST(dof AS DOUBLE) / 2)", "(s / 2)"
    return f"""
SELECT feature, round(s, {digits}) AS statistic, dof, round(CASE WHEN dof = 0 OR s <= 0 THEN CAST(1 AS DOUBLE) ELSE 1 - list_sum(list_transform(
         range(CAST({x} + 14 * sqrt({x}) + 60 * sqrt({a}) + 200 AS BIGINT)),
         lambda i: exp(({a} + i) * ln({x}) - {x} - lgamma({a} + i + 1)))) END, 8) AS p_value
FROM ({cells.replace('AS statistic', 'AS s').replace(', 6) AS s', ', 12) AS s')}) t"""


@register("m14_chi_square_p", with_views(_gamma_sql(_m14_body("hwc_h", _M14), 6), "hwc_h"))
def m14_chi_square_p(spark, d):
    """M14 with p-values as expressions."""
    out = M.chi_square_with_p(_hwc(spark, d), _M14, "has_accident")
    return out.withColumns({"statistic": r6(F.col("statistic")), "p_value": F.round("p_value", 8)})


_MANY = {"many": "fact_id * 7919 % 12007", "injured": "injured", "weekday": "fact_id % 7"}


@register("m14_chi_square_many_values", with_views(
    _gamma_sql(_m14_body("many", list(_MANY)).replace("has_accident", "killed"), 4), "facts_d",
    extra={"many": "SELECT killed, " + ", ".join(f"{x} AS {n}" for n, x in _MANY.items()) + " FROM facts_d"}))
def m14_chi_square_many_values(spark, d):
    """M14 on all line items with a feature of more values than ``ChiSquareTest`` takes."""
    rows = V.facts_d(spark, d).selectExpr("killed", *[f"{x} AS {n}" for n, x in _MANY.items()])
    out = M.chi_square_with_p(rows, list(_MANY), "killed")
    return out.withColumns({"statistic": F.round("statistic", 4), "p_value": F.round("p_value", 8)})


# Fixed value: the seven features of the source's test, in its order.
_M14_ALL = ["pedestrians", "temperature", "precipitation", "has_event", "hour_group", "day", "weather"]


@register("m14_chi_square_balanced", with_views(
    _m14_body("area_bal", _M14_ALL, ", TRUE AS p_in_range, TRUE AS ml_agrees"), "hwc_area", extra={"area_bal": _AREA_BAL}))
def m14_chi_square_balanced(spark, d):
    """M14 as the source runs it: seven features of the balanced sample, with p-values; the library
    statistic and degrees of freedom are compared with those of ``ChiSquareTest``."""
    data = materialize(Q.area_dataset(V.ctx_h(spark, d), V.facts_h(spark, d), AREA_ZIP)
                       .select(*_M14_ALL, "has_accident"), "m14-input")
    ours = M.chi_square(data, _M14_ALL, "has_accident")
    ml = M.chi_square_test(M.index_label(M.assemble(data, _M14_ALL), "has_accident"))
    names = F.array(*[F.lit(f) for f in _M14_ALL])
    ml = ml.select(F.get(names, F.col("feature_index")).alias("f"), "p_value", F.col("dof").alias("ml_dof"),
                   F.col("statistic").alias("ml_statistic"))
    same = (F.col("dof") == F.col("ml_dof")) & (F.abs(F.col("statistic") - F.col("ml_statistic")) < 1e-6)
    return ours.join(ml, F.col("feature") == F.col("f")).select(
        "feature", r6(F.col("statistic")).alias("statistic"), "dof", F.col("p_value").between(0, 1).alias("p_in_range"),
        same.alias("ml_agrees"))


@register("m13_correlation_balanced", with_views(_m13_body("area_bal", _M13), "hwc_area", extra={"area_bal": _AREA_BAL}))
def m13_correlation_balanced(spark, d):
    """M13 on the balanced sample."""
    data = Q.area_dataset(V.ctx_h(spark, d), V.facts_h(spark, d), AREA_ZIP)
    return M.correlation_matrix(data, _M13).withColumn("r", r6(F.col("r")))


_M13_SCALED = [f"{c}_norm" for c in ("pedestrians", "temperature", "precipitation", "hour", "day", "weather")] + ["has_accident"]


@register("m13_correlation_scaled", with_views(_m13_body("training", _M13_SCALED), "hwc_h", extra=TRAINING))
def m13_correlation_scaled(spark, d):
    """M13 on the scaled training table."""
    return M.correlation_matrix(_training(spark, d), _M13_SCALED).withColumn("r", r6(F.col("r")))


# =============================================================================
# Analyses (Q1-Q7)
# =============================================================================

@register("q1_prepare_facts", Q1_SQL)
def q1_prepare_facts(spark, d):
    return _q1(spark, d)


LINES_BOROUGH = "BROOKLYN"
LINES_LO, LINES_HI = "1997-01-01", "1999-12-31"


@register("q1_prepare_facts_from_lines", with_views(f"""
SELECT CAST(c[1] AS BIGINT) AS fact_id, crash_ts, date_trunc('hour', crash_ts) AS fact_hour, c[5] AS zip_code,
       TRY_CAST(c[11] AS INTEGER) + TRY_CAST(c[13] AS INTEGER) + TRY_CAST(c[15] AS INTEGER) AS injured,
       TRY_CAST(c[12] AS INTEGER) + TRY_CAST(c[14] AS INTEGER) + TRY_CAST(c[16] AS INTEGER) AS killed,
       CASE WHEN c[17] = '-1' THEN 'Unspecified' ELSE c[17] END AS factor
FROM (SELECT c, try_strptime(concat(c[2], ' ', c[3]), '%m/%d/%Y %H:%M') AS crash_ts,
             CAST(try_strptime(c[2], '%m/%d/%Y') AS DATE) AS crash_day
      FROM (SELECT string_split(value, ',') AS c FROM crash_clean) t WHERE c[4] = {q(LINES_BOROUGH)}) r
WHERE crash_day > DATE '{LINES_LO}' AND crash_day < DATE '{LINES_HI}'""", "crash_clean"))
def q1_prepare_facts_from_lines(spark, d):
    """The full crash path: raw lines -> cleaner -> named table -> Q1."""
    table = C.crash_table(V.crash_lines(spark, d), key_col="line_key")
    return Q.prepare_facts(table, LINES_BOROUGH, LINES_LO, LINES_HI)


Q2_BODY = """
SELECT try_strptime(hour_beginning, '%m/%d/%Y %I:%M:%S %p') AS hour_begin,
       TRY_CAST(pedestrians AS INTEGER) AS pedestrians, weather_summary,
       TRY_CAST(temperature AS DOUBLE) AS temperature, TRY_CAST(precipitation AS DOUBLE) AS precipitation,
       events AS event_name, CASE WHEN events IS NULL THEN 0 ELSE 1 END AS has_event
FROM ctx_raw WHERE weather_summary IS NOT NULL"""


@register("q2_prepare_context", with_views(Q2_BODY.replace("FROM ctx_raw", "FROM ctx_raw_all"), "ctx_raw_all"))
def q2_prepare_context(spark, d):
    return Q.prepare_context(V.ctx_raw_all(spark, d))


@register("q3_training_table", with_views("SELECT * FROM training", "hwc_h", extra=TRAINING))
def q3_training_table(spark, d):
    return _training(spark, d)


@register("q3_training_table_from_raw", with_views("SELECT * FROM training", "crash_raw", "ctx_raw", extra={
    "facts_raw": Q1_BODY,
    "ctx_prep": "SELECT hour_begin, pedestrians, weather_summary, temperature, precipitation, event_name "
                "FROM (" + Q2_BODY + ") p",
    "hwc_raw": hours_with_crashes_sql("facts_raw", "ctx_prep"),
    "bal": f"SELECT * FROM hwc_raw WHERE {_BAL}",
    "training": Q3_BODY}))
def q3_training_table_from_raw(spark, d):
    """The model input built the way the final model script does: Q1 and Q2 on raw
    strings, then K1, labels, balancing and scaling."""
    facts = Q.prepare_facts(V.crash_raw(spark, d), BOROUGH, DATE_LO, DATE_HI)
    return Q.training_table(Q.prepare_context(V.ctx_raw(spark, d)), facts)


@register("q3_fitted_rows", with_views(
    "SELECT count(*) AS n_table, count(*) AS n_fitted FROM training", "hwc_h", extra=TRAINING))
def q3_fitted_rows(spark, d):
    """Every row of the training table reaches the fit."""
    table = _training(spark, d)
    n = Q.model_input(table, Q.FINAL_FEATURES, "q3-input").agg(F.count(F.lit(1)).alias("n_fitted"))
    return table.agg(F.count(F.lit(1)).alias("n_table")).join(n)


def _metric_sizes(spark, rows) -> DataFrame:
    r = {m: v for _, m, v in rows}
    # a metric is null where it is undefined (one class only), which is no value within bounds
    flags = all(v is not None and 0.0 <= v <= 1.0 for _, m, v in rows if m.startswith(("auc", "accuracy")))
    return _rows(spark, [(int(r["n_train"]), int(r["n_test"]), flags)], "n_train long, n_test long, in_bounds boolean")


@register("q4_split_sizes", with_views(_SPLIT_SQL.format(
    pick=split_pick("sample_key", 0.7, Q.FINAL_SPLIT_SEED), rest="TRUE AS in_bounds", src="training"),
    "hwc_h", extra=TRAINING))
def q4_split_sizes(spark, d):
    """Q4: training and test rows of the final model, and metrics within [0, 1]."""
    _, rows = Q.train_crash_model(_training(spark, d), max_iter=30)
    return _metric_sizes(spark, rows)


@register("q7_split_sizes", with_views(_SPLIT_SQL.format(
    pick=split_pick("sample_key", 0.7, Q.AREA_SPLIT_SEED), rest="TRUE AS in_bounds", src="area_bal"),
    "hwc_area", extra={"area_bal": _AREA_BAL}))
def q7_split_sizes(spark, d):
    """Q7: training and test rows of the area models, and metrics within [0, 1]."""
    return _metric_sizes(spark, Q.area_model(V.ctx_h(spark, d), V.facts_h(spark, d), AREA_ZIP, max_iter=30))


@register("q5_written_result", _q5_sql())
def q5_written_result(spark, d):
    """Q5 as the source ends it: one CSV file, read back."""
    path = scratch_path(spark, "q5")
    io.write_csv(_q5(spark, d), path, single_file=True, null_value="<null>")
    return spark.read.option("header", True).option("nullValue", "<null>").schema(
        "weather string, factor string, weather_count long, weather_factor_count long, frac double").csv(path)


@register("q4_train_crash_model")
def q4_train_crash_model(spark, d):
    checkpoint_root(spark)
    _, rows = Q.train_crash_model(_training(spark, d), model_path=scratch_path(spark, "q4"))
    return _rows(spark, rows, METRIC_SCHEMA)


@register("q5_factor_share_from_raw", with_views(
    "SELECT weather, factor, CAST(weather_count AS BIGINT) AS weather_count, weather_factor_count, frac "
    "FROM (" + A1_SQL.format(src="cw_raw") + ") t", "crash_raw", "ctx_raw",
    extra={"facts_raw": Q1_BODY, "ctx_prep": Q2_BODY,
           "cw_raw": "SELECT f.*, c.* FROM facts_raw f JOIN ctx_prep c ON f.fact_hour = c.hour_begin"}))
def q5_factor_share_from_raw(spark, d):
    """The whole chain on raw strings: Q1 and Q2 preparation, then K2 and A1."""
    facts = Q.prepare_facts(V.crash_raw(spark, d), BOROUGH, DATE_LO, DATE_HI)
    return Q.factor_share(facts, Q.prepare_context(V.ctx_raw(spark, d)))


@register("q5_factor_share", _q5_sql())
def q5_factor_share(spark, d):
    return _q5(spark, d)


@register("q5_factor_share_daily", _q5_sql("cw_d"))
def q5_factor_share_daily(spark, d):
    return Q.factor_share(V.facts_d(spark, d), V.ctx_d(spark, d), Q.DAILY)


@register("q5_factor_share_daily_shuffle", _q5_sql("cw_d"))
def q5_factor_share_daily_shuffle(spark, d):
    """Q5 on the path taken when the context is too large to broadcast."""
    return Q.factor_share(V.facts_d(spark, d), V.ctx_d(spark, d), Q.DAILY, broadcast=False)


def _q6_sql(src: str) -> str:
    return with_views(f"""
SELECT weather_summary AS weather, factor, CAST(sum(injured) AS BIGINT) AS injured,
       CAST(sum(killed) AS BIGINT) AS killed, CAST(sum(injured + killed) AS BIGINT) AS casualties
FROM {src} GROUP BY weather_summary, factor""", src)


@register("q6_written_result", _q6_sql("cw_h"))
def q6_written_result(spark, d):
    """Q6 as the source ends it: one CSV file, read back."""
    path = scratch_path(spark, "q6")
    io.write_csv(Q.factor_casualties(V.facts_h(spark, d), V.ctx_h(spark, d)), path, single_file=True, null_value="<null>")
    return spark.read.option("header", True).option("nullValue", "<null>").schema(
        "weather string, factor string, injured long, killed long, casualties long").csv(path)


@register("q6_factor_casualties", _q6_sql("cw_h"))
def q6_factor_casualties(spark, d):
    return Q.factor_casualties(V.facts_h(spark, d), V.ctx_h(spark, d))


def _bucketed_crashes(spark, d) -> DataFrame:
    """The daily joined rows from buckets, with the factor label cleaned."""
    pair = K.bucketed_pair(V.facts_d(spark, d).withColumn("factor", X.sentinel_to_label("factor")),
                           FL.drop_null_rows(V.ctx_d(spark, d), ["weather_summary"]), "fact_day", "day_begin", BUCKETS)
    return K.join_buckets(*pair, "fact_day", "day_begin")


@register("q5_factor_share_from_buckets", _q5_sql("cw_d"))
def q5_factor_share_from_buckets(spark, d):
    """Q5 on the bucketed stage."""
    return A.factor_share_by_weather(_bucketed_crashes(spark, d))


@register("q6_factor_casualties_from_buckets", _q6_sql("cw_d"))
def q6_factor_casualties_from_buckets(spark, d):
    """Q6 on the bucketed stage."""
    return A.casualties_by_weather_factor(_bucketed_crashes(spark, d))


@register("q6_factor_casualties_daily", _q6_sql("cw_d"))
def q6_factor_casualties_daily(spark, d):
    return Q.factor_casualties(V.facts_d(spark, d), V.ctx_d(spark, d), Q.DAILY)


@register("q6_factor_casualties_daily_shuffle", _q6_sql("cw_d"))
def q6_factor_casualties_daily_shuffle(spark, d):
    """Q6 on the path taken when the context is too large to broadcast."""
    return Q.factor_casualties(V.facts_d(spark, d), V.ctx_d(spark, d), Q.DAILY, broadcast=False)


@register("k1_context_left_facts_daily_shuffle", with_views(
    "SELECT c.*, f.* FROM ctx_d c LEFT JOIN facts_d f ON c.day_begin = f.fact_day", "ctx_d", "facts_d"))
def k1_context_left_facts_daily_shuffle(spark, d):
    """K1 without broadcast: shuffle inner join plus anti join on distinct fact keys."""
    return K.context_left_facts(V.ctx_d(spark, d), V.facts_d(spark, d), "day_begin", "fact_day",
                                broadcast=False)


@register("k1_context_left_facts_daily_salted", with_views(
    "SELECT c.*, f.* FROM ctx_d c LEFT JOIN facts_d f ON c.day_begin = f.fact_day", "ctx_d", "facts_d"))
def k1_context_left_facts_daily_salted(spark, d):
    """K1 on the no-broadcast path with explicit salting (8 salts)."""
    return K.context_left_facts(V.ctx_d(spark, d), V.facts_d(spark, d), "day_begin", "fact_day",
                                broadcast=False, salt=8)


@register("q7_area_model")
def q7_area_model(spark, d):
    checkpoint_root(spark)
    rows = Q.area_model(V.ctx_h(spark, d), V.facts_h(spark, d), AREA_ZIP)
    return _rows(spark, rows, METRIC_SCHEMA)

