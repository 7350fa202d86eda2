"""Sharding by extendible hashing (DataFrame operations only).

A directory is indexed by the first bits of a row hash. A bucket whose bytes exceed the
limit is split on the next bit, and only such buckets are, until every bucket fits or holds
a single hash. Bytes are summed per directory cell once, a few bits deeper than a balanced
directory needs; sums of the shallower buckets follow from the cells. Only the rows of
cells that are still too large are looked at again, with more bits.

Rows of one hash (repeated rows) cannot be told apart by bits: their bucket gets a chain of
overflow shards, each within the limit. A single row above the limit has a shard of its own.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourglass.session import materialize

SHARD_BYTES = 1 << 20
HASH_BITS = 60
EXTRA_BITS = 3


def hashed(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_bytes, h): UTF-8 bytes of the text (null: 0) and a 60-bit hash of id and text."""
    text = F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text).cast("binary"))
    return docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"),
                       F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long").alias("h"),
                       *[F.col(c) for c in keep])


def _prefix(depth: int):
    return F.shiftrightunsigned("h", HASH_BITS - depth)


def directory(rows: DataFrame, limit: int = SHARD_BYTES) -> list[tuple[int, DataFrame]]:
    """[(bits, cells)]: cells (cell, depth, bucket_bytes) map the first ``bits`` bits of a hash to
    the depth of its bucket. A later entry refines cells with a null depth in the one before it."""
    total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    bits = min(HASH_BITS, max(1, math.ceil(math.log2(max(1, total / limit))) + EXTRA_BITS))
    levels, pending, low = [], rows, 0
    while True:
        cells = pending.groupBy(_prefix(bits).alias("cell")).agg(
            F.sum("n_bytes").alias("bytes"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        depths = F.explode(F.sequence(F.lit(low), F.lit(bits)))
        up = cells.select("*", depths.alias("depth"))
        bucket = F.expr(f"shiftrightunsigned(cell, {bits} - depth)")
        buckets = up.groupBy("depth", bucket.alias("bucket")).agg(
            F.sum("bytes").alias("bucket_bytes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        done = buckets.filter((F.col("bucket_bytes") <= limit) | (F.col("lo") == F.col("hi")))
        first = (up.select("cell", "depth", bucket.alias("bucket")).join(done, ["depth", "bucket"])
                 .groupBy("cell").agg(F.min(F.struct("depth", "bucket_bytes")).alias("b")))
        level = cells.select("cell").join(first, "cell", "left").select(
            "cell", F.col("b.depth").alias("depth"), F.col("b.bucket_bytes").alias("bucket_bytes"))
        level = materialize(level, "shard-directory")
        levels.append((bits, level))
        too_large = level.filter("depth is null").select("cell")
        if bits == HASH_BITS or too_large.isEmpty():
            return levels
        pending = pending.withColumn("cell", _prefix(bits)).join(too_large, "cell", "left_semi").drop("cell")
        low, bits = bits + 1, min(HASH_BITS, bits + 8)


def assign(rows: DataFrame, levels: list[tuple[int, DataFrame]], limit: int = SHARD_BYTES,
           keep: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with shard (bits of the bucket), depth, chain (overflow shard) and bucket_bytes."""
    out = rows.withColumn("depth", F.lit(None).cast("int")).withColumn("bucket_bytes", F.lit(None).cast("long"))
    for bits, cells in levels:
        cells = cells.select("cell", F.col("depth").alias("d"), F.col("bucket_bytes").alias("b"))
        out = (out.withColumn("cell", F.when(F.col("depth").isNull(), _prefix(bits)))
               .join(cells, "cell", "left")
               .withColumns({"depth": F.coalesce("depth", "d"), "bucket_bytes": F.coalesce("bucket_bytes", "b")})
               .drop("cell", "d", "b"))
    # overflow chains: only buckets of one hash can still exceed the limit
    over = F.col("bucket_bytes") > limit
    chained = chain_repeats(out.filter(over), limit, keep)
    out = out.filter(~over).withColumn("chain", F.lit(0)).unionByName(chained)
    shard = F.expr(f"lpad(bin(shiftrightunsigned(h, {HASH_BITS} - depth)), depth, '0')")
    return out.select("doc_id", "n_bytes", *keep, shard.alias("shard"), "depth", "chain", "bucket_bytes")


def chain_repeats(rows: DataFrame, limit: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of one hash dealt into overflow shards (``chain``), each within the limit.

    Such rows are repeats: they are counted (merged before the shuffle, so a row that a third of the
    table repeats is no load), a count gives its chains, and the chains give the rows back, spread by chain.
    Unlike rows of one hash have chains of their own, one after the other.
    """
    same = ["h", "doc_id", "n_bytes", "depth", "bucket_bytes", *keep]
    per = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("n_bytes", F.lit(1))))
    counts = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("m")).withColumn("per", per)
    counts = counts.withColumn("chains", F.ceil(F.col("m") / F.col("per")).cast("int"))
    unlike = Window.partitionBy("h").orderBy("doc_id", "n_bytes", *keep)
    first = F.sum("chains").over(unlike.rowsBetween(Window.unboundedPreceding, -1))
    chains = (counts.withColumn("first", F.coalesce(first, F.lit(0)).cast("int"))
              .withColumn("c", F.explode(F.sequence(F.lit(0), F.col("chains") - 1)))
              .withColumn("chain", F.col("first") + F.col("c")).repartition("h", "chain"))
    left = F.least(F.col("per"), F.col("m") - F.col("c") * F.col("per"))
    return (chains.withColumn("copy", F.explode(F.array_repeat(F.lit(0), left.cast("int"))))
            .select(*same, "chain"))


def shard(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, shard, depth, chain, bucket_bytes for every row.

    Null texts have no bytes and a null doc_id counts as an empty one; repeated rows share a
    bucket (and its chain); an empty table gives no row; other columns are ignored.
    """
    rows = materialize(hashed(docs), "shard-rows")
    return assign(rows, directory(rows, limit), limit)


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """Write the texts as one Parquet folder per shard and overflow chain."""
    levels = directory(materialize(hashed(docs), "shard-rows"), limit)
    out = assign(hashed(docs, keep=("text",)), levels, limit, keep=("text",))
    (out.withColumn("shard", F.concat("shard", F.lit("-"), "chain")).drop("chain")
     .repartition("shard").write.partitionBy("shard").parquet(path))
