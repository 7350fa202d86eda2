"""Profiling (P1-P13). Each profile is one aggregation job over all requested columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# First cells that mark a header line in raw or cleaned crash files.
CRASH_HEADER_FIRST_CELLS = ("CRASH DATE", "0")
RECORDS_LABEL = "Number of records in the dataset:"


def _first_cell(col: str):
    return F.substring_index(F.col(col), ",", 1)


def count_records(df: DataFrame, value_col: str = "value",
                  header_first_cells: Sequence[str] = CRASH_HEADER_FIRST_CELLS,
                  label: str = RECORDS_LABEL) -> DataFrame:
    """Lines whose first cell is not a header marker; one labelled row."""
    keep = ~_first_cell(value_col).isin(*header_first_cells)
    return df.agg(F.count_if(keep).alias("n_records")).select(
        F.lit(label).alias("label"), "n_records")


def count_records_skip_header(df: DataFrame, key_col: str = "offset", value_col: str = "value",
                              token: str = "location") -> DataFrame:
    """Skip the line at key 0 if it contains ``token``; count the rest."""
    header = (F.col(key_col) == F.lit(0)) & F.col(value_col).contains(token)
    return df.agg(F.count_if(~F.coalesce(header, F.lit(False))).alias("n_records"))


def row_count(df: DataFrame) -> DataFrame:
    """P3 as a table (``df.count()`` is the action form)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, one row, one pass."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def sentinel_counts(df: DataFrame, cols: Sequence[str], sentinel="-1") -> DataFrame:
    """P5: rows equal to the sentinel per column, one pass."""
    return df.agg(*[F.count_if(F.col(c) == F.lit(sentinel)).alias(c) for c in cols])


def value_counts(df: DataFrame, col: str, sort: str | None = "count") -> DataFrame:
    """Rows per value. ``sort`` = 'count' (desc, ties by value), 'value' (desc) or None."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if sort == "count":
        out = out.orderBy(F.desc("count"), F.asc_nulls_first(col))
    elif sort == "value":
        out = out.orderBy(F.desc_nulls_last(col))
    return out


def count_distinct(df: DataFrame, cols: Sequence[str], approx: bool = False,
                   rsd: float = 0.01) -> DataFrame:
    """Distinct non-null values per column.

    Exact by default (every distinct value is shuffled once). ``approx=True`` uses
    HyperLogLog++ sketches (``approx_count_distinct``, relative error ``rsd``): fixed
    size per task, merged in one step, for high-cardinality columns at scale.
    """
    if approx:
        return df.agg(*[F.approx_count_distinct(F.col(c), rsd).alias(c) for c in cols])
    return df.agg(*[F.count_distinct(F.col(c)).alias(c) for c in cols])


def min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``min_<c>`` and ``max_<c>`` for all columns in one pass."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P10: count, mean, sample stddev, min, max per column as a long, typed table."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"{c}__count").alias("count"),
                     F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__stddev").alias("stddev"),
                     F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"))
            for c in cols]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values, kept as a DataFrame (never collected)."""
    return df.select(col).distinct()


def schema_report(df: DataFrame):
    """(position, column, type) of a DataFrame; metadata only, no job."""
    return [(i, name, dtype) for i, (name, dtype) in enumerate(df.dtypes)]


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows per class."""
    return value_counts(df, label, sort="count")
