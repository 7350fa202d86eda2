"""Filters, projections and casts.

Written as plain ``filter``/``select`` so Catalyst merges them and pushes the
predicates into the parquet scan.
"""

from __future__ import annotations

import datetime as dt
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions.scalars import row_sum as _row_sum


def _lit_date(v) -> "F.Column":
    if isinstance(v, str):
        v = dt.date.fromisoformat(v)
    return F.lit(v)


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    """equality (borough, zip code, one hour)."""
    return df.filter(F.col(col) == F.lit(value))


def filter_date_open(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """``lo < col < hi`` with both ends excluded; null dates drop out."""
    c = F.col(col)
    return df.filter((c > _lit_date(lo)) & (c < _lit_date(hi)))


def filter_valid_geo(df: DataFrame, lat: str = "latitude", lon: str = "longitude",
                     lat_min: float = 0.0, lon_max: float = -2.0) -> DataFrame:
    """positions in the north-west quadrant (drops -1 sentinels and zeros)."""
    return df.filter((F.col(lat) > F.lit(lat_min)) & (F.col(lon) < F.lit(lon_max)))


def filter_null(df: DataFrame, col: str) -> DataFrame:
    """rows where ``col`` is null."""
    return df.filter(F.col(col).isNull())


def drop_null_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """drop rows with a null in any of ``cols``."""
    return df.na.drop(subset=list(cols))


_OPS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
        "=": operator.eq, "==": operator.eq, "!=": operator.ne}


def filter_cmp(df: DataFrame, col: str, op: str, value) -> DataFrame:
    """numeric comparison."""
    return df.filter(_OPS[op](F.col(col), F.lit(value)))


def filter_not_eq(df: DataFrame, col: str, value) -> DataFrame:
    """``col != value`` (nulls drop out, as with SQL inequality)."""
    return df.filter(F.col(col) != F.lit(value))


def select_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """J0."""
    return df.select(*cols)


def drop_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """J1."""
    return df.drop(*cols)


def cast_cols(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Tolerant casts in one projection (bad text becomes null)."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def row_sum(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """``out`` = sum of ``cols``; null if any input is null."""
    return df.withColumn(out, _row_sum(cols))
