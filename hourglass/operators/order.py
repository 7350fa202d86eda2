"""Ordering, limits and set operations.

``top_n`` is a limit over a total order, which Spark runs as a per-task top-n and
one small merge (TakeOrderedAndProject), never a full sort.

Full sorts are range-partitioned, and a range partitioner sends equal keys to one
partition: a value that holds a third of all rows would be sorted by a single task.
``spread_ties`` appends a unique row id as the last sort key. The order of tied rows
is unspecified anyway, and with the id a hot value spans several range partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order(col: str, tiebreak: Sequence[str] = ()):
    return [F.desc_nulls_last(col), *[F.asc_nulls_first(t) for t in tiebreak]]


_TIE = "__tie"


def _spread_sort(df: DataFrame, keys: list, spread_ties: bool) -> DataFrame:
    if not spread_ties:
        return df.orderBy(*keys)
    return (df.withColumn(_TIE, F.monotonically_increasing_id())
            .orderBy(*keys, F.col(_TIE)).drop(_TIE))


def sort_desc(df: DataFrame, col: str, tiebreak: Sequence[str] = (), spread_ties: bool = True) -> DataFrame:
    """Sort by one column descending (nulls last), optional ascending tie-breakers."""
    return _spread_sort(df, _order(col, tiebreak), spread_ties)


def top_n(df: DataFrame, col: str, n: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows by ``col`` descending; tie-breakers make it deterministic."""
    return df.orderBy(*_order(col, tiebreak)).limit(n)


def head(df: DataFrame, n: int, order: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows; pass ``order`` for a reproducible answer."""
    return (df.orderBy(*order) if order else df).limit(n)


def top_factors(shares: DataFrame, weather: str | None = None, exclude: str | None = "Unspecified",
                by: str = "frac", n: int | None = None) -> DataFrame:
    """T4: ranked factors of one weather (or of all), without ``exclude``."""
    out = shares
    if weather is not None:
        out = out.filter(F.col("weather") == F.lit(weather))
    if exclude is not None:
        out = out.filter(F.col("factor") != F.lit(exclude))
    out = out.orderBy(*_order(by, ("weather", "factor")))
    return out.limit(n) if n else out


def top_per_group(df: DataFrame, group: str, by: str, n: int, tiebreak: Sequence[str] = (), rank: str = "rank",
                  salt: int = 0) -> DataFrame:
    """T4 for all groups at once: the first ``n`` rows of every group by ``by`` descending, with their rank.

    Every task keeps at most n rows of a group before the shuffle (Spark's group limit under the rank
    filter), so a hot group sends n rows per task, not its rows. The limit applies up to 1,000 rows; for a
    larger n, ``salt`` > 1 first ranks a hot group in as many parts. Null groups are one group.
    """
    order = _order(by, tiebreak)
    if salt > 1:
        part = F.pmod(F.xxhash64(by, *tiebreak), F.lit(salt))
        first = df.withColumn("_part", part)
        first = first.withColumn("_r", F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order)))
        df = first.filter(F.col("_r") <= n).drop("_part", "_r")
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.filter(F.col(rank) <= n)


def sort_lines(df: DataFrame, col: str = "value", spread_ties: bool = True) -> DataFrame:
    """T5: byte order (range-partitioned sort, many reducers; repeated lines spread)."""
    return _spread_sort(df, [F.col(col)], spread_ties)


def union_all(a: DataFrame, b: DataFrame, by_name: bool = False) -> DataFrame:
    """Duplicates kept; positional by default, types widened."""
    return a.unionByName(b) if by_name else a.union(b)


def distinct(df: DataFrame) -> DataFrame:
    """U2."""
    return df.distinct()
