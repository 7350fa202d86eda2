"""Feature scaling.

Measured ranges come from one global aggregate that Spark runs as a scalar
subquery (``DataFrame.scalar()``): partial min/max per task, one tiny merge, and
the result is inlined into the projection. No window over the whole table (that
would pull every row into one partition), no cross join, no driver round trip.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def range_stats(df: DataFrame, cols: Sequence[str]) -> Column:
    """A struct scalar ``{<c>_min, <c>_max}`` for all columns, computed in one pass."""
    fields = []
    for c in cols:
        x = F.col(c).cast("double")
        fields += [F.min(x).alias(f"{c}_min"), F.max(x).alias(f"{c}_max")]
    return df.select(F.struct(*fields)).scalar()


def min_max_scale(df: DataFrame, cols: Sequence[str] | str,
                  out: Mapping[str, str] | None = None) -> DataFrame:
    """``(x - min) / (max - min)`` with min and max measured on ``df``.

    A constant column (min = max) gives null instead of a division error. ``df`` is
    read twice (ranges, then scaling): write an expensive input once first
    (``hourglass.session.materialize``).
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    out = dict(out or {c: f"{c}_norm" for c in cols})
    # Bind the scalar once: each field access on the subquery expression itself
    # would be planned as a separate subquery (and recompute ``df`` once per use).
    staged = df.withColumn("__range", range_stats(df, cols))
    rng = F.col("__range")
    return staged.withColumns({
        out[c]: F.try_divide(F.col(c).cast("double") - rng[f"{c}_min"],
                             rng[f"{c}_max"] - rng[f"{c}_min"])
        for c in cols}).drop("__range")


def fixed_range_scale(c, lo: float, hi: float) -> Column:
    """``(x - lo) / (hi - lo)`` with a known range."""
    c = F.col(c) if isinstance(c, str) else c
    return (c.cast("double") - F.lit(float(lo))) / F.lit(float(hi - lo))


def max_scale(c, m: float) -> Column:
    """``x / m``."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double") / F.lit(float(m))


def norm_params(df: DataFrame, measured: Sequence[tuple[str, str]],
                fixed: Sequence[tuple[str, float, float]], order: Sequence[str] | None = None) -> DataFrame:
    """Long table (variable, min, max) of measured and fixed ranges.

    ``measured`` = [(variable name, column)], ``fixed`` = [(variable name, lo, hi)].
    One aggregate over ``df``; the rows are produced with ``stack``, not driver rows.
    """
    aggs = []
    for name, col in measured:
        x = F.col(col).cast("double")
        aggs += [F.min(x).alias(f"{name}__min"), F.max(x).alias(f"{name}__max")]
    wide = df.agg(*aggs)
    entries = {name: (F.col(f"{name}__min"), F.col(f"{name}__max")) for name, _ in measured}
    entries.update({name: (F.lit(float(lo)), F.lit(float(hi))) for name, lo, hi in fixed})
    names = list(order or entries)
    rows = [F.struct(F.lit(n).alias("variable"), entries[n][0].alias("min"), entries[n][1].alias("max"))
            for n in names]
    return wide.select(F.inline(F.array(*rows)))
