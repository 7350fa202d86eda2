"""Aggregations.

Every per-condition result is one ``groupBy`` (partial aggregation map-side, so a
hot condition is pre-summed inside each task before the shuffle), instead of a
driver loop with one job per (condition, factor) pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.operators.profile import value_counts


def factor_share_by_weather(joined: DataFrame, weather: str = "weather_summary",
                            factor: str = "factor", weight: str | None = None) -> DataFrame:
    """A1: per (weather, factor): ``weather_count``, ``weather_factor_count``, ``frac``.

    A null factor forms its own group with count 0 (``count(factor)``) while its rows
    still count towards the weather total. The totals are grouped sums of the aggregated pairs,
    joined back (null-safe), so no task holds all pairs of a weather. ``weight`` names a row-count
    column when the input was pre-aggregated.
    """
    f = F.col(factor)
    rows = F.sum(F.col(weight)) if weight else F.count(F.lit(1))
    pairs = joined.groupBy(F.col(weather).alias("weather"), f.alias("factor")).agg(rows.cast("bigint").alias("_rows"))
    # same grouped exchange on both sides, so Spark runs it once
    total = pairs.groupBy(F.col("weather").alias("_w")).agg(F.sum("_rows").alias("weather_count"))
    known = F.when(F.col("factor").isNull(), F.lit(0)).otherwise(F.col("_rows")).cast("bigint")
    return pairs.join(total, F.col("weather").eqNullSafe(F.col("_w"))).select(
        "weather", "factor", "weather_count", known.alias("weather_factor_count"),
    ).withColumn("frac", F.col("weather_factor_count").cast("double") / F.col("weather_count").cast("double"))


def casualties_by_weather_factor(joined: DataFrame, weather: str = "weather_summary",
                                 factor: str = "factor", injured: str = "injured",
                                 killed: str = "killed", casualties: str | None = None) -> DataFrame:
    """A2: per (weather, factor): sums of injured, killed and casualties (bigint).

    ``casualties`` defaults to ``injured + killed`` per row (null when either is null).
    """
    cas = F.col(casualties) if casualties else F.col(injured) + F.col(killed)
    return joined.groupBy(F.col(weather).alias("weather"), F.col(factor).alias("factor")).agg(
        F.sum(F.col(injured).cast("bigint")).alias("injured"),
        F.sum(F.col(killed).cast("bigint")).alias("killed"),
        F.sum(cas.cast("bigint")).alias("casualties"))


def count_where(df: DataFrame, pred: Column, name: str = "n") -> DataFrame:
    """A3: filtered count as one aggregate."""
    return df.agg(F.count_if(pred).alias(name))


def global_agg(df: DataFrame, *exprs: Column) -> DataFrame:
    """A4: aggregates without a key (partial per task, one tiny final merge)."""
    return df.agg(*exprs)


def event_rate_by_bucket(df: DataFrame, bucket: str, pred: Column) -> DataFrame:
    """A5: per bucket: all rows, rows matching ``pred`` and their ratio, in one pass."""
    return df.groupBy(bucket).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(pred).alias("n_event"),
    ).withColumn("rate", F.col("n_event").cast("double") / F.col("n_rows").cast("double"))


def count_by_class_and_bucket(df: DataFrame, label: str, positive, bucket: str) -> DataFrame:
    """Rows of the positive class per bucket, most frequent first."""
    return value_counts(df.filter(F.col(label) == F.lit(positive)), bucket, sort="count")


def prediction_counts(pred: DataFrame, col: str = "prediction") -> DataFrame:
    """Rows per predicted class."""
    return value_counts(pred, col, sort="count")


def grouped_sums(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Helper: bigint sums of ``cols`` per ``keys``."""
    return df.groupBy(*keys).agg(*[F.sum(F.col(c).cast("bigint")).alias(c) for c in cols])


# --- A1 and A2 kept up to date -------------------------------------------------

_PARTIAL = ("n_rows", "injured", "killed", "casualties")


def factor_partials(joined: DataFrame, weather: str = "weather_summary", factor: str = "factor",
                    injured: str = "injured", killed: str = "killed") -> DataFrame:
    """Mergeable sums behind A1 and A2: one row per (weather, factor) with rows and casualties."""
    return joined.groupBy(F.col(weather).alias("weather"), F.col(factor).alias("factor")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(injured).cast("bigint")).alias("injured"),
        F.sum(F.col(killed).cast("bigint")).alias("killed"),
        F.sum((F.col(injured) + F.col(killed)).cast("bigint")).alias("casualties"))


def merge_partials(*parts: DataFrame) -> DataFrame:
    """The sums of all ``parts``; sums of nothing but nulls stay null."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy("weather", "factor").agg(*[F.sum(c).alias(c) for c in _PARTIAL])


def update_partials(spark: SparkSession, root: str, batch: int, joined: DataFrame) -> DataFrame:
    """Version ``batch`` of the stored sums under ``root``: version ``batch - 1`` merged with the new rows.

    Only the new rows are read, with one row per pair of the stored sums. Versions are written whole,
    so a batch that is run again gives the same version. The first batch is 0.
    """
    new = factor_partials(joined)
    if batch > 0:
        new = merge_partials(spark.read.parquet(f"{root}/version={batch - 1}"), new)
    new.write.mode("overwrite").parquet(f"{root}/version={batch}")
    return spark.read.parquet(f"{root}/version={batch}")


def shares_of_partials(partials: DataFrame) -> DataFrame:
    """A1 from the stored sums."""
    return factor_share_by_weather(partials, weather="weather", factor="factor", weight="n_rows")


def casualties_of_partials(partials: DataFrame) -> DataFrame:
    """A2 from the stored sums."""
    return partials.select("weather", "factor", "injured", "killed", "casualties")
