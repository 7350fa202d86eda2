"""Sampling and splitting.

``df.sample`` depends on how rows fall into partitions, so the same seed can pick
different rows after a repartition. The default here is a hash sample: a row is
kept when a hash of (seed, key) falls below ``fraction * 2^32``. It is a pure
per-row predicate (no shuffle, no state), gives the same rows on any cluster
layout, and can be reproduced in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.operators.joins import fits_broadcast
from hourglass.session import materialize

_SPACE = 1 << 32


def threshold(fraction: float) -> int:
    return int(fraction * _SPACE)


def row_key(df: DataFrame, key) -> Column:
    """``key`` as text; where it is null, a hash of the whole row (map columns aside), so rows
    without a key are sampled and split like any others instead of being dropped."""
    key = F.col(key) if isinstance(key, str) else key
    cells = [F.coalesce(F.col(f"`{f.name}`").cast("string"), F.lit(""))
             for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.coalesce(key.cast("string"), F.md5(F.concat_ws("|", *cells).cast("binary")))


def hash_bucket(key, seed: int, method: str = "md5", purpose: str = "") -> Column:
    """Uniform integer in [0, 2^32) from (purpose, seed, key); a null key counts as ''.

    'md5' is reproducible in other SQL engines; 'xxhash64' is several times cheaper.
    ``purpose`` separates draws that share seed and key (balancing and a later split).
    """
    key = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.lit(f"{purpose}{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    if method == "xxhash64":
        return F.pmod(F.xxhash64(text), F.lit(_SPACE))
    if method not in ("md5", "hash"):
        raise ValueError(f"unknown hash method {method!r}")
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_pick(key, fraction: float, seed: int, method: str = "md5") -> Column:
    return hash_bucket(key, seed, method) < F.lit(threshold(fraction))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """B1: Spark's own sample without replacement (layout-dependent)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, key, fraction: float, seed: int, method: str = "md5") -> DataFrame:
    """B2: layout-independent sample on a row key (rows without a key: on the row)."""
    return df.filter(hash_pick(row_key(df, key), fraction, seed, method))


def balance_classes(df: DataFrame, label: str, keep, fraction: float, seed: int,
                    key=None, method: str = "md5") -> DataFrame:
    """Keep class ``keep`` whole and sample every other class (null labels included) at ``fraction``.

    ``method``: 'md5' (default) or 'xxhash64', one filter over one scan on the row key;
    'native' uses ``sampleBy`` on "is the kept class" (layout-dependent, like ``df.sample``).
    """
    kept = F.coalesce(F.col(label) == F.lit(keep), F.lit(False))
    if method == "native":
        return df.sampleBy(kept, {True: 1.0, False: fraction}, seed)
    if key is None:
        raise ValueError("hash balancing needs a row key")
    return df.filter(kept | hash_pick(row_key(df, key), fraction, seed, method))


_REFINE = (11, 11, 10)  # bits of the bucket settled by each histogram


def class_thresholds(buckets: DataFrame, sizes: DataFrame) -> DataFrame:
    """(label, threshold): per class the greatest threshold with at most ``target`` rows whose bucket is below it.

    ``buckets``: label, bucket in [0, 2^32); ``sizes``: label, target. Found by histograms of the
    bucket's leading bits, refined inside the one bin per class where the target is crossed:
    three counts over the rows, no sort. A histogram has 2,048 rows per class at most.
    """
    state = sizes.select(F.col("label").alias("_l"), F.col("target").alias("_left"), F.lit(0).cast("bigint").alias("_at"))
    shift = 32
    for level, bits in enumerate(_REFINE):
        width = shift  # bits below what is settled so far
        shift -= bits
        rows = buckets.join(state, F.col("label").eqNullSafe(F.col("_l")))
        bin_ = F.shiftright("bucket", shift)
        # in the crossing bin so far: the settled leading bits agree
        rows = rows.filter(F.shiftright("bucket", width) == F.shiftright("_at", width)) if level else rows
        counts = rows.groupBy("_l", "_left", "_at", bin_.alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
        upto = Window.partitionBy("_l").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cum = counts.withColumn("_cum", F.sum("_n").over(upto))
        # the first bin that crosses the target; without one the whole class fits
        crossed = cum.filter("_cum > _left").groupBy("_l").agg(
            F.min(F.struct("_bin", (F.col("_left") - (F.col("_cum") - F.col("_n"))).alias("_rest"))).alias("_c"))
        name = F.col("_l").alias("_m")
        state = state.join(crossed.select(name, "_c"), F.col("_l").eqNullSafe(F.col("_m")), "left").select(
            "_l", F.coalesce("_c._rest", "_left").alias("_left"),
            F.when(F.col("_c").isNotNull(), F.shiftleft(F.col("_c._bin"), shift)).otherwise(F.lit(_SPACE)).alias("_at"))
        state = materialize(state, "class-thresholds")
    return state.select(F.col("_l").alias("label"), F.col("_at").alias("threshold"))


def balance_to_sizes(df: DataFrame, label: str, seed: int, key, sizes: dict | None = None, method: str = "md5") -> DataFrame:
    """B3 to exact sizes: of every class the rows of the smallest hashes, as many as ``sizes`` says.

    ``sizes`` maps labels to numbers of rows (classes it lacks are kept whole); without it every
    class is cut to the size of the smallest. Null labels are a class. Rows are known by ``key``,
    so the choice does not depend on their layout; rows of one hash stay or go together, so a class
    can fall short of its size by less than the rows of one hash. Classes are few; rows of a class need not be.
    """
    bucket = hash_bucket(row_key(df, key), seed, method)
    data = df.withColumn("_bucket", bucket)
    buckets = materialize(data.select(F.col(label).alias("label"), F.col("_bucket").alias("bucket")), "balance-buckets")
    held = materialize(buckets.groupBy("label").agg(F.count(F.lit(1)).alias("held")), "balance-classes")
    if sizes is None:
        targets = held.select("label", held.agg(F.min("held")).scalar().alias("target"))
    else:
        target = F.col("held")
        for value, n in sizes.items():
            target = F.when(F.col("label").eqNullSafe(F.lit(value)), F.least(F.col("held"), F.lit(int(n)))).otherwise(target)
        targets = held.select("label", target.alias("target"))
    limits = class_thresholds(buckets, targets).select(F.col("label").alias("_label"), F.col("threshold").alias("_limit"))
    return (data.join(F.broadcast(limits) if fits_broadcast(limits) else limits, F.col(label).eqNullSafe(F.col("_label")))
            .filter(F.col("_bucket") < F.col("_limit")).select(*[F.col(f"`{c}`") for c in df.columns]))


SPLIT = "split:"  # keeps a split independent of a balancing draw on the same seed and key


def train_test_split(df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 1823,
                     key=None, method: str = "native") -> list[DataFrame]:
    """Random split. 'native' = ``randomSplit``; 'md5' or 'xxhash64' = stable split on ``key``
    whose parts add up to ``df`` (rows without a key: on the row)."""
    if method == "native":
        return df.randomSplit(list(weights), seed)
    total = float(sum(weights))
    bucket = hash_bucket(row_key(df, key), seed, method, SPLIT)
    parts, lo = [], 0
    for i, w in enumerate(weights):
        hi = _SPACE if i == len(weights) - 1 else lo + threshold(w / total)
        parts.append(df.filter((bucket >= F.lit(lo)) & (bucket < F.lit(hi))))
        lo = hi
    return parts
