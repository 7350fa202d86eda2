"""DuckDB SQL for the look-alike views and shared derived tables.

Each view mirrors ``hourglass.plans.lookalike`` (and the derived joins in
``hourglass.plans.analyses``) cell by cell, so a query and its SQL oracle read
the same driver tables. ``with_views(body, *names)`` prefixes the needed views
(dependencies included) as common table expressions.
"""

from __future__ import annotations

from hourglass.functions.lines import CRASH_DROP_ORDINALS, CRASH_FIELDS
from hourglass.functions.scalars import WEATHER_LABELS
from hourglass.operators.clean import CONTEXT_KEEP_ORDINALS
from hourglass.operators.sample import SPLIT, threshold
from hourglass.plans.lookalike import CONTEXT_HEADER, CRASH_HEADER, QUIET_HOURS, UNSEEN_HOURS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def weather_label(x: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {q(w)}" for i, w in enumerate(WEATHER_LABELS))
    return f"CASE {x} {whens} END"


def weather_code(x: str) -> str:
    whens = " ".join(f"WHEN {q(w)} THEN {i}" for i, w in enumerate(WEATHER_LABELS))
    return f"CASE {x} {whens} END"


def factor_of(uid: str) -> str:
    return f"CASE WHEN {uid} % 7 = 0 THEN '-1' ELSE concat('F', CAST({uid} % 7 AS VARCHAR)) END"


def zip_of(x: str) -> str:
    return f"concat('1120', CAST({x} % 5 AS VARCHAR))"


def hour_key(t: str) -> str:
    return (f"(year({t}) * 1000000 + month({t}) * 10000 + day({t}) * 100 + hour({t}))")


def hash_bucket(key: str, seed: int, purpose: str = "") -> str:
    return (f"CAST(('0x' || substr(md5(concat('{purpose}{seed}', ':', CAST({key} AS VARCHAR))), 1, 8)) AS BIGINT)")


def hash_pick(key: str, fraction: float, seed: int, purpose: str = "") -> str:
    return f"{hash_bucket(key, seed, purpose)} < {threshold(fraction)}"


def split_pick(key: str, fraction: float, seed: int) -> str:
    """Rows of the first part of a hash split."""
    return hash_pick(key, fraction, seed, SPLIT)


def row_key(key: str, *columns: str) -> str:
    cells = ", '|', ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"coalesce(CAST({key} AS VARCHAR), md5(concat({cells})))"


def repair(v: str) -> str:
    return (f"CASE WHEN length({v}) - length(replace({v}, ',', '')) > {CRASH_FIELDS - 1} THEN "
            f"CASE WHEN regexp_matches({v}, '\\(.*\\)') THEN regexp_replace({v}, '\\(.*\\)', '', 'g') "
            f"ELSE regexp_replace({v}, '\"(.*),(.*)\"', '\\1\\2', 'g') END ELSE {v} END")


KEPT = [i for i in range(CRASH_FIELDS) if i not in CRASH_DROP_ORDINALS]


def kept_cells(arr: str = "cells") -> list[str]:
    return [f"CASE WHEN len({arr}) <> {CRASH_FIELDS} THEN '-1' WHEN {arr}[{i + 1}] = '' THEN '-1' "
            f"ELSE {arr}[{i + 1}] END" for i in KEPT]


_LINE_CELLS = [
    "strftime(o_orderdate, '%m/%d/%Y')",
    "concat(CAST(o_orderkey % 24 AS VARCHAR), ':', lpad(CAST(o_custkey % 60 AS VARCHAR), 2, '0'))",
    "CASE WHEN o_orderstatus = 'O' THEN 'BROOKLYN' WHEN o_orderstatus = 'F' THEN 'QUEENS' ELSE 'BRONX' END",
    "CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE CAST(11200 + o_custkey % 10 AS VARCHAR) END",
    "concat('40.', CAST(o_custkey % 1000 AS VARCHAR))",
    "concat('-73.', CAST(o_orderkey % 1000 AS VARCHAR))",
    "CASE WHEN o_orderkey % 3 = 0 THEN '\"(40.1, -73.9)\"' ELSE '' END",
    "CASE WHEN o_orderkey % 5 = 0 THEN '\"MAIN ST, APT 2\"' ELSE 'MAIN ST' END",
    "'CROSS ST'", "''",
    "CAST(o_orderkey % 3 AS VARCHAR)", "'0'",
    "CAST(o_orderkey % 2 AS VARCHAR)", "'0'", "CAST(o_custkey % 2 AS VARCHAR)", "'0'",
    "CAST(o_orderkey % 3 AS VARCHAR)", "'0'",
    "o_orderpriority", "'Unspecified'", "''", "''", "''",
    "CAST(o_orderkey AS VARCHAR)",
    "'Sedan'", "o_orderstatus", "''", "''", "''",
]

_CTX_LINE_CELLS = [
    "coalesce(hour_beginning, '')", "location", "pedestrians", "towards_manhattan",
    "towards_brooklyn", "coalesce(weather_summary, '')",
    "CAST(CAST(floor(CAST(temperature AS DOUBLE)) AS BIGINT) AS VARCHAR)",
    "CAST(CAST(floor(CAST(precipitation AS DOUBLE)) AS BIGINT) AS VARCHAR)",
    "lat", "CASE WHEN ctx_key % 17 = 0 THEN '' ELSE long END", "coalesce(events, '')", "location1",
]

K_EXPR = "CAST(json_extract_string(props, '$.k') AS INTEGER)"



def moved_events(hours: tuple[int, int]) -> str:
    """Events, one hour earlier where their hour is one of ``hours``."""
    number = "(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) * 24 + hour(ts))"
    return (f"(SELECT * REPLACE (CASE WHEN {number} % {hours[0]} = {hours[1]} THEN ts - INTERVAL 1 HOUR ELSE ts END AS ts) "
            "FROM events) events")


VIEWS: dict[str, str] = {
    "facts_h": f"""
SELECT event_id AS fact_id, ts AS crash_ts, date_trunc('hour', ts) AS fact_hour,
       {zip_of('user_id')} AS zip_code, {factor_of('user_id')} AS factor,
       {K_EXPR} % 5 AS injured,
       CASE WHEN {K_EXPR} >= 95 THEN 1 ELSE 0 END AS killed
FROM {moved_events(QUIET_HOURS)}""",
    "ctx_h": f"""
SELECT hour_begin, pedestrians, {weather_label('CAST(_m % 11 AS INTEGER)')} AS weather_summary,
       temperature, precipitation, CASE WHEN _m % 7 = 0 THEN 'parade' END AS event_name
FROM (SELECT date_trunc('hour', ts) AS hour_begin, CAST(count(*) AS INTEGER) AS pedestrians,
             max(value) AS temperature, min(value) AS precipitation, sum(user_id) AS _m
      FROM {moved_events(UNSEEN_HOURS)} GROUP BY 1) g""",
    "facts_d": f"""
SELECT l_orderkey * 8 + l_linenumber AS fact_id, l_shipdate AS crash_ts, l_shipdate AS fact_day,
       {zip_of('l_suppkey')} AS zip_code, concat(l_returnflag, l_linestatus) AS factor,
       CAST(l_quantity AS INTEGER) AS injured,
       CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS killed
FROM lineitem""",
    "ctx_d": f"""
SELECT day_begin, pedestrians, {weather_label('CAST(_m % 11 AS INTEGER)')} AS weather_summary,
       temperature, precipitation, CASE WHEN _m % 7 = 0 THEN 'parade' END AS event_name
FROM (SELECT o_orderdate AS day_begin, CAST(count(*) AS INTEGER) AS pedestrians,
             max(o_totalprice) AS temperature, min(o_totalprice) AS precipitation, count(*) AS _m
      FROM orders GROUP BY 1) g""",
    "crash_raw": f"""
SELECT event_id AS row_id,
       CASE WHEN event_id % 13 = 0 THEN '' ELSE strftime(ts, '%m/%d/%Y') END AS crash_date,
       CASE WHEN event_id % 13 = 0 THEN '' ELSE strftime(ts, '%-H:%M') END AS crash_time,
       upper(event_type) AS borough, {zip_of('user_id')} AS zip_code,
       CAST(k % 3 AS VARCHAR) AS ped_injured,
       CASE WHEN k >= 98 THEN '1' ELSE '0' END AS ped_killed,
       CASE WHEN event_id % 11 = 0 THEN '' ELSE CAST(k % 2 AS VARCHAR) END AS cyc_injured,
       '0' AS cyc_killed,
       CAST(k % 4 AS VARCHAR) AS mot_injured,
       CASE WHEN k = 50 THEN '1' ELSE '0' END AS mot_killed,
       {factor_of('user_id')} AS factor_1
FROM (SELECT *, {K_EXPR} AS k FROM {moved_events(QUIET_HOURS)}) e""",
    "ctx_raw": """
SELECT hk AS ctx_key,
       CASE WHEN hk % 13 = 0 THEN NULL ELSE strftime(hour_begin, '%m/%d/%Y %-I:%-M:%-S %p') END AS hour_beginning,
       'bridge' AS location,
       CAST(pedestrians AS VARCHAR) AS pedestrians,
       CAST(CAST(floor(pedestrians / 2) AS BIGINT) AS VARCHAR) AS towards_manhattan,
       CAST(pedestrians - CAST(floor(pedestrians / 2) AS BIGINT) AS VARCHAR) AS towards_brooklyn,
       weather_summary,
       CAST(temperature AS VARCHAR) AS temperature,
       CAST(precipitation AS VARCHAR) AS precipitation,
       '40.70' AS lat, '-73.99' AS long,
       event_name AS events, '' AS location1
FROM (SELECT *, """ + hour_key("hour_begin") + """ AS hk FROM ctx_h) c""",
    "crash_lines": f"""
SELECT CAST(0 AS BIGINT) AS line_key, {q(','.join(CRASH_HEADER))} AS value
UNION ALL
SELECT o_orderkey + 1 AS line_key,
       CASE WHEN o_orderkey % 17 = 0 THEN concat_ws(',', {', '.join(_LINE_CELLS[:27])})
            ELSE concat_ws(',', {', '.join(_LINE_CELLS)}) END AS value
FROM orders""",
    "ctx_lines": f"""
SELECT CAST(0 AS BIGINT) AS line_key, {q(','.join(CONTEXT_HEADER))} AS value
UNION ALL
SELECT ctx_key AS line_key, concat_ws(',', {', '.join(_CTX_LINE_CELLS)}) AS value FROM ctx_raw""",
    "geo": """
SELECT c_custkey AS geo_id, c_acctbal / CAST(100 AS DOUBLE) AS latitude,
       CAST(c_nationkey AS DOUBLE) - CAST(12 AS DOUBLE) AS longitude,
       CAST(c_nationkey AS VARCHAR) AS zip_code, c_mktsegment AS segment
FROM customer""",
    # C1-C13 on the raw crash lines.
    "crash_cells": f"""
SELECT line_key, {repair('value')} AS rep, string_split({repair('value')}, ',') AS cells FROM crash_lines""",
    "crash_clean": f"""
SELECT line_key AS row_key, len(cells) <> {CRASH_FIELDS} AS is_malformed,
       concat_ws(',', CAST(line_key AS VARCHAR), {', '.join(kept_cells())}) AS value,
       concat_ws(',', {', '.join(kept_cells())}) AS cells_line
FROM crash_cells""",
    "ctx_cells": """
SELECT line_key, value, string_split(regexp_replace(value, ',+$', ''), ',') AS cells FROM ctx_lines""",
    # K2 on the hourly pair with the factor label cleaned (Q5/Q6 input).
    "cw_h": """
SELECT f.fact_id, f.crash_ts, f.fact_hour, f.zip_code,
       CASE WHEN f.factor = '-1' THEN 'Unspecified' ELSE f.factor END AS factor,
       f.injured, f.killed, c.*
FROM facts_h f JOIN ctx_h c ON f.fact_hour = c.hour_begin WHERE c.weather_summary IS NOT NULL""",
    "cw_d": """
SELECT f.fact_id, f.crash_ts, f.fact_day, f.zip_code,
       CASE WHEN f.factor = '-1' THEN 'Unspecified' ELSE f.factor END AS factor,
       f.injured, f.killed, c.*
FROM facts_d f JOIN ctx_d c ON f.fact_day = c.day_begin WHERE c.weather_summary IS NOT NULL""",
    # K1 with the derived model columns (Q3 input), and the zip-narrowed variant (Q7).
    "hwc_h": "",
    "facts_area": "SELECT * FROM facts_h WHERE zip_code = '11202'",
    "hwc_area": "",
}



def hours_with_crashes_sql(facts: str, ctx: str = "ctx_h") -> str:
    return f"""
SELECT c.*, f.*,
       {weather_code('c.weather_summary')} AS weather,
       f.injured + f.killed AS casualties,
       CAST(hour(c.hour_begin) AS INTEGER) AS hour,
       CAST(floor(hour(c.hour_begin) / 4) AS INTEGER) AS hour_group,
       CAST(isodow(c.hour_begin) AS INTEGER) AS day,
       CASE WHEN c.event_name IS NULL THEN 0 ELSE 1 END AS has_event,
       coalesce(f.fact_id, -{hour_key('c.hour_begin')}, -c.pedestrians, 0) AS sample_key,
       CASE WHEN f.injured + f.killed IS NULL THEN 0 ELSE 1 END AS has_accident
FROM {ctx} c LEFT JOIN {facts} f ON c.hour_begin = f.fact_hour"""


VIEWS["hwc_h"] = hours_with_crashes_sql("facts_h")
VIEWS["hwc_area"] = hours_with_crashes_sql("facts_area")

# The unfiltered pair and what is derived from it.
VIEWS["facts_all"] = VIEWS["facts_h"].replace(moved_events(QUIET_HOURS), "events")
VIEWS["ctx_all"] = VIEWS["ctx_h"].replace(moved_events(UNSEEN_HOURS), "events")
VIEWS["ctx_raw_all"] = VIEWS["ctx_raw"].replace("FROM ctx_h)", "FROM ctx_all)")
VIEWS["ctx_lines_all"] = VIEWS.pop("ctx_lines").replace("FROM ctx_raw", "FROM ctx_raw_all")
VIEWS["ctx_cells_all"] = VIEWS.pop("ctx_cells").replace("FROM ctx_lines", "FROM ctx_lines_all")

DEPS: dict[str, tuple[str, ...]] = {
    "ctx_raw": ("ctx_h",),
    "ctx_raw_all": ("ctx_all",),
    "ctx_lines_all": ("ctx_raw_all",),
    "crash_cells": ("crash_lines",),
    "crash_clean": ("crash_cells",),
    "ctx_cells_all": ("ctx_lines_all",),
    "cw_h": ("facts_h", "ctx_h"),
    "cw_d": ("facts_d", "ctx_d"),
    "hwc_h": ("facts_h", "ctx_h"),
    "facts_area": ("facts_h",),
    "hwc_area": ("facts_area", "ctx_h"),
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in DEPS.get(n, ()):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH <views> <body>``; ``extra`` adds query-local CTEs after the views."""
    ctes = [f"{n} AS ({VIEWS[n].strip()})" for n in _closure(names)]
    ctes += [f"{n} AS ({sql.strip()})" for n, sql in (extra or {}).items()]
    return ("WITH " + ",\n".join(ctes) + "\n" + body.strip()) if ctes else body.strip()


__all__ = ["VIEWS", "with_views", "hash_pick", "hash_bucket", "split_pick", "row_key", "weather_code", "weather_label", "hours_with_crashes_sql",
           "kept_cells", "KEPT", "CONTEXT_KEEP_ORDINALS", "q", "hour_key", "repair"]
