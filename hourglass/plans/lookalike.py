"""Look-alike inputs derived from the driver tables (checks and bench).

The driver tables hold no crashes, so each role of the source project is played by
a view whose work grows with the underlying table:

* ``facts_h`` / ``ctx_h``   - incidents and hourly context from ``events``
* ``facts_d`` / ``ctx_d``   - bench-size incidents and daily context from
  ``lineitem`` / ``orders``
* ``crash_raw`` / ``ctx_raw`` - the same data as raw strings (dates as text, blanks)
* ``crash_lines`` / ``ctx_lines`` - raw delimited lines with broken cells and headers
* ``geo``                   - positions and zip codes from ``customer``

The same definitions are written in SQL in ``hourglass.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.functions.scalars import decode_weather, trunc_time

# Column names of the raw crash export (29 cells) and the hourly
# pedestrian export (12 cells), used for the header lines.
CRASH_HEADER = (
    "CRASH DATE", "CRASH TIME", "BOROUGH", "ZIP CODE", "LATITUDE", "LONGITUDE", "LOCATION",
    "ON STREET NAME", "CROSS STREET NAME", "OFF STREET NAME",
    "NUMBER OF PERSONS INJURED", "NUMBER OF PERSONS KILLED",
    "NUMBER OF PEDESTRIANS INJURED", "NUMBER OF PEDESTRIANS KILLED",
    "NUMBER OF CYCLIST INJURED", "NUMBER OF CYCLIST KILLED",
    "NUMBER OF MOTORIST INJURED", "NUMBER OF MOTORIST KILLED",
    "CONTRIBUTING FACTOR VEHICLE 1", "CONTRIBUTING FACTOR VEHICLE 2",
    "CONTRIBUTING FACTOR VEHICLE 3", "CONTRIBUTING FACTOR VEHICLE 4",
    "CONTRIBUTING FACTOR VEHICLE 5", "COLLISION_ID",
    "VEHICLE TYPE CODE 1", "VEHICLE TYPE CODE 2", "VEHICLE TYPE CODE 3",
    "VEHICLE TYPE CODE 4", "VEHICLE TYPE CODE 5",
)
CONTEXT_HEADER = (
    "hour_beginning", "location", "Pedestrians", "Towards Manhattan", "Towards Brooklyn",
    "weather_summary", "temperature", "precipitation", "lat", "long", "events", "Location1",
)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _factor(uid: Column) -> Column:
    m = uid % 7
    return F.when(m == 0, F.lit("-1")).otherwise(F.concat(F.lit("F"), m.cast("string")))


def _zip(x: Column) -> Column:
    return F.concat(F.lit("1120"), (x % 5).cast("string"))


def hour_key(ts: Column) -> Column:
    """Integer yyyymmddhh of a wall-clock time (time-zone free)."""
    return (F.year(ts).cast("bigint") * 1000000 + F.month(ts) * 10000 + F.dayofmonth(ts) * 100
            + F.hour(ts))


# --- hourly pair -------------------------------------------------------------
#
# Every event is a crash and a context record. So that hours without crash, and crashes without
# context, exist at every table size, the events of some hours count for the hour before:
# as crashes those of every fifth hour, as context records those of every eleventh.

QUIET_HOURS = (5, 3)     # hours whose number has this remainder see no crash
UNSEEN_HOURS = (11, 4)   # ... and these have no context row


def hour_number(ts: Column) -> Column:
    """Hours of wall-clock time since 1970."""
    return F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")) * 24 + F.hour(ts)


def moved(ts: Column, hours: tuple[int, int]) -> Column:
    """``ts``, one hour earlier where its hour is one of ``hours``."""
    return F.when(hour_number(ts) % hours[0] == hours[1], ts - F.expr("INTERVAL 1 HOUR")).otherwise(ts)


def facts_h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents of the joins: every event; none in the quiet hours."""
    return _facts(table(spark, sf_dir, "events").withColumn("ts", moved(F.col("ts"), QUIET_HOURS)))


def facts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an incident at its own time, for operators that need no unmatched rows."""
    return _facts(table(spark, sf_dir, "events"))


def _facts(ev: DataFrame) -> DataFrame:
    k = _k()
    return ev.select(
        F.col("event_id").alias("fact_id"),
        F.col("ts").alias("crash_ts"),
        trunc_time("ts").alias("fact_hour"),
        _zip(F.col("user_id")).alias("zip_code"),
        _factor(F.col("user_id")).alias("factor"),
        (k % 5).alias("injured"),
        F.when(k >= 95, F.lit(1)).otherwise(F.lit(0)).alias("killed"),
    )


def _context(grouped: DataFrame, time_col: str) -> DataFrame:
    m = F.col("_m")
    return grouped.select(
        time_col, "pedestrians",
        decode_weather((m % 11).cast("int")).alias("weather_summary"),
        "temperature", "precipitation",
        F.when(m % 7 == 0, F.lit("parade")).alias("event_name"),
    )


def ctx_h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of the joins: every event; no row for the unseen hours."""
    return _hours(table(spark, sf_dir, "events").withColumn("ts", moved(F.col("ts"), UNSEEN_HOURS)))


def ctx_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of every event, for operators that need no unmatched rows."""
    return _hours(table(spark, sf_dir, "events"))


def _hours(ev: DataFrame) -> DataFrame:
    grouped = ev.groupBy(trunc_time("ts").alias("hour_begin")).agg(
        F.count(F.lit(1)).cast("int").alias("pedestrians"),
        F.max("value").alias("temperature"),
        F.min("value").alias("precipitation"),
        F.sum("user_id").alias("_m"))
    return _context(grouped, "hour_begin")


# --- daily pair (bench size) -------------------------------------------------

def facts_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("fact_id"),
        F.col("l_shipdate").alias("crash_ts"),
        F.col("l_shipdate").alias("fact_day"),
        _zip(F.col("l_suppkey")).alias("zip_code"),
        F.concat("l_returnflag", "l_linestatus").alias("factor"),
        F.col("l_quantity").cast("int").alias("injured"),
        F.when(F.col("l_linenumber") == 7, F.lit(1)).otherwise(F.lit(0)).alias("killed"),
    )


def ctx_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    grouped = o.groupBy(F.col("o_orderdate").alias("day_begin")).agg(
        F.count(F.lit(1)).cast("int").alias("pedestrians"),
        F.max("o_totalprice").alias("temperature"),
        F.min("o_totalprice").alias("precipitation"),
        F.count(F.lit(1)).alias("_m"))
    return _context(grouped, "day_begin")


# --- raw strings -------------------------------------------------------------

def crash_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").withColumn("ts", moved(F.col("ts"), QUIET_HOURS))
    k = _k()
    blank = F.col("event_id") % 13 == 0

    def text(x: Column) -> Column:
        return F.when(blank, F.lit("")).otherwise(x)

    return ev.select(
        F.col("event_id").alias("row_id"),
        text(F.date_format("ts", "MM/dd/yyyy")).alias("crash_date"),
        text(F.date_format("ts", "H:mm")).alias("crash_time"),
        F.upper("event_type").alias("borough"),
        _zip(F.col("user_id")).alias("zip_code"),
        (k % 3).cast("string").alias("ped_injured"),
        F.when(k >= 98, F.lit("1")).otherwise(F.lit("0")).alias("ped_killed"),
        F.when(F.col("event_id") % 11 == 0, F.lit("")).otherwise((k % 2).cast("string")).alias("cyc_injured"),
        F.lit("0").alias("cyc_killed"),
        (k % 4).cast("string").alias("mot_injured"),
        F.when(k == 50, F.lit("1")).otherwise(F.lit("0")).alias("mot_killed"),
        _factor(F.col("user_id")).alias("factor_1"),
    )


def ctx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_context(ctx_h(spark, sf_dir))


def ctx_raw_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_context(ctx_all(spark, sf_dir))


def _raw_context(c: DataFrame) -> DataFrame:
    hk = hour_key(F.col("hour_begin"))
    ped = F.col("pedestrians")
    return c.select(
        hk.alias("ctx_key"),
        F.when(hk % 13 == 0, F.lit(None).cast("string"))
        .otherwise(F.date_format("hour_begin", "MM/dd/yyyy h:m:s a")).alias("hour_beginning"),
        F.lit("bridge").alias("location"),
        ped.cast("string").alias("pedestrians"),
        F.floor(ped / 2).cast("string").alias("towards_manhattan"),
        (ped - F.floor(ped / 2)).cast("string").alias("towards_brooklyn"),
        "weather_summary",
        F.col("temperature").cast("string").alias("temperature"),
        F.col("precipitation").cast("string").alias("precipitation"),
        F.lit("40.70").alias("lat"),
        F.lit("-73.99").alias("long"),
        F.col("event_name").alias("events"),
        F.lit("").alias("location1"),
    )


# --- raw lines ---------------------------------------------------------------

def crash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_key, value): a header line with key 0, then one line per order."""
    o = table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    s = lambda x: x.cast("string")
    e = F.lit("")
    cells = [
        F.date_format("o_orderdate", "MM/dd/yyyy"),
        F.concat(s(key % 24), F.lit(":"), F.lpad(s(cust % 60), 2, "0")),
        F.when(F.col("o_orderstatus") == "O", F.lit("BROOKLYN"))
        .when(F.col("o_orderstatus") == "F", F.lit("QUEENS")).otherwise(F.lit("BRONX")),
        F.when(key % 4 == 0, e).otherwise(s(11200 + cust % 10)),
        F.concat(F.lit("40."), s(cust % 1000)),
        F.concat(F.lit("-73."), s(key % 1000)),
        F.when(key % 3 == 0, F.lit('"(40.1, -73.9)"')).otherwise(e),
        F.when(key % 5 == 0, F.lit('"MAIN ST, APT 2"')).otherwise(F.lit("MAIN ST")),
        F.lit("CROSS ST"), e,
        s(key % 3), F.lit("0"),
        s(key % 2), F.lit("0"), s(cust % 2), F.lit("0"), s(key % 3), F.lit("0"),
        F.col("o_orderpriority"), F.lit("Unspecified"), e, e, e,
        s(key),
        F.lit("Sedan"), F.col("o_orderstatus"), e, e, e,
    ]
    line = F.when(key % 17 == 0, F.concat_ws(",", *cells[:27])).otherwise(F.concat_ws(",", *cells))
    data = o.select((key + 1).alias("line_key"), line.alias("value"))
    header = spark.range(1).select(F.lit(0).cast("bigint").alias("line_key"),
                                   F.lit(",".join(CRASH_HEADER)).alias("value"))
    return header.unionByName(data)


def ctx_lines_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_key, value): header with key 0, then one 12-cell line per hour of any event."""
    r = ctx_raw_all(spark, sf_dir)
    e = F.lit("")
    temp = F.floor(F.col("temperature").cast("double")).cast("string")
    prec = F.floor(F.col("precipitation").cast("double")).cast("string")
    cells = [F.coalesce("hour_beginning", e), "location", "pedestrians", "towards_manhattan",
             "towards_brooklyn", F.coalesce("weather_summary", e), temp, prec, "lat",
             F.when(F.col("ctx_key") % 17 == 0, e).otherwise(F.col("long")),
             F.coalesce("events", e), "location1"]
    data = r.select(F.col("ctx_key").alias("line_key"), F.concat_ws(",", *cells).alias("value"))
    header = spark.range(1).select(F.lit(0).cast("bigint").alias("line_key"),
                                   F.lit(",".join(CONTEXT_HEADER)).alias("value"))
    return header.unionByName(data)


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("geo_id"),
        (F.col("c_acctbal") / F.lit(100.0)).alias("latitude"),
        (F.col("c_nationkey").cast("double") - F.lit(12.0)).alias("longitude"),
        F.col("c_nationkey").cast("string").alias("zip_code"),
        F.col("c_mktsegment").alias("segment"),
    )
