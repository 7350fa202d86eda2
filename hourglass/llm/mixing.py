"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Sizes are summed per source and the wanted total is shared by weight; a target above
   ``max_repeats`` times its source is cut and the excess reshared (water-filling).
2. A target is whole passes over its source plus a rest. The documents of a source are
   hashed into blocks, the blocks ordered by a seeded permutation, and the rest takes
   blocks from the front until it is met; the last block is taken document by document.
   Rounds over the unused texts then go on along the permutation, past what does not fit,
   until the rest left is smaller than every unused text.
3. Each source's exact block quota is split among the output shards by a binary tree: a
   node deals its vector of block counts between its two halves by a multivariate
   hypergeometric draw, so quotas add up exactly and every shard is a fair draw.
4. A shard owns a disjoint range of every source's permuted blocks and orders its
   documents by a hash: that is the local shuffle.

Only per-source sums reach the driver. Choices depend on text and id hashes and on
the seed, so reruns agree.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.operators.joins import fits_broadcast
from hourglass.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
TOTAL_SHARE = 1.5
MAX_REPEATS = 2
BLOCKS = 1024             # least blocks per source; more shards get more
BLOCKS_A_SHARD = 16
SHARD_WORDS = 4_000_000   # words of an output shard; very large corpora want a larger figure
MAX_SHARDS = 1 << 14
SEED = 9
_WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, h1, h2): words of each whole text (null: 0) and two row hashes."""
    return docs.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("size"),
        *_hashes())


def _hashes() -> list[Column]:
    return [F.xxhash64(F.lit(SEED + k), "doc_id", "text").alias(f"h{k + 1}") for k in (0, 1)]


def targets(rows: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE,
            max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target), one row per source.

    Weights repeat along the sources in code point order, null last. The excess of capped
    targets is reshared until none is above its cap: with sources ordered by cap per
    weight, the capped ones are a prefix of that order.
    """
    s = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = s.withColumn("weight", F.get(w, (F.row_number().over(by_name) - 1) % len(weights)))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
    s = s.withColumn("budget", F.sum("source_size").over(Window.partitionBy()) * total_share - F.coalesce(
        F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("level", F.col("budget") / F.sum("weight").over(
        by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    s = s.withColumn("nth", F.row_number().over(by_cap))
    # the first source that is not capped at its level fixes the level of all that follow
    free = F.min(F.when(F.col("weight") * F.col("level") < F.col("cap"), F.struct("nth", "level")))
    s = s.withColumn("free", free.over(Window.partitionBy())["level"])
    target = F.least("cap", F.coalesce(F.col("weight") * F.col("free"), F.col("cap")))
    return s.select("source", "source_size", target.alias("target"))


def split_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards x sources) counts that add up to ``quotas``: halves by multivariate hypergeometric draws."""
    if shards == 1:
        return quotas[None]
    left = shards // 2
    total = int(quotas.sum())
    draw = (rng.multivariate_hypergeometric(quotas, round(total * left / shards), method="marginals")
            if total else np.zeros_like(quotas))
    return np.concatenate([split_tree(draw, left, rng), split_tree(quotas - draw, shards - left, rng)])


def layout(rows: DataFrame, total_share: float = TOTAL_SHARE, shard_words: int = SHARD_WORDS) -> tuple[int, int]:
    """(shards, blocks per source) for the size of the mix."""
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] * total_share
    shards = min(MAX_SHARDS, max(1, math.ceil(total / shard_words)))
    return shards, max(BLOCKS, BLOCKS_A_SHARD * shards)


def fill(units: DataFrame, left: DataFrame) -> DataFrame:
    """(s, h1, h2) of the texts that the rest takes beyond the first block that does not fit.

    ``units`` (s, nth, h1, h2, words): unused texts by permuted block; ``left`` (s, left): words
    left of each rest. A round takes, in permuted order, the texts of up to half of what is left
    until one does not fit: prefix sums over blocks, then over the texts of one block. Where no text
    is that small, it takes the first that fits. Two rounds at least halve what is left, so
    the rounds end after twice its logarithm, with no unused text that still fits.
    """
    units = materialize(units, "mix-units")
    kind = "array<struct<cap:double,stop:bigint,at:struct<h2:bigint,h1:bigint>,one:boolean>>"
    state = materialize(left.select("s", "left", F.array().cast(kind).alias("rules")), "mix-left")
    here = F.struct("h2", "h1")

    def by_rule(r: Column) -> Column:
        at = F.col("nth") == r["stop"]
        upto = r["stop"].isNull() | (F.col("nth") < r["stop"]) | (at & (here <= r["at"]))
        return F.when(r["one"], at & (here == r["at"])).otherwise((F.col("words") <= r["cap"]) & upto)

    def by_source(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
        b = b.withColumnRenamed("s", "_s")
        return a.join(b, F.col("s").eqNullSafe(F.col("_s")), how).drop("_s")

    def unused(state: DataFrame) -> DataFrame:
        taken = F.coalesce(F.exists("rules", by_rule), F.lit(False))
        return by_source(units, state, "inner").filter(~taken & (F.col("words") <= F.col("left")))

    small = F.col("words") * 2 <= F.col("left")
    while True:
        blocks = unused(state).groupBy("s", "nth").agg(
            F.first("left").alias("most"), F.sum(F.when(small, F.col("words"))).alias("sum"),
            F.min(F.struct("nth", "h2", "h1", "words")).alias("first"))
        order = Window.partitionBy("s").orderBy("nth")
        walk = blocks.withColumn("upto", F.when(F.col("sum").isNotNull(), F.sum("sum").over(order)))
        walk = walk.groupBy("s").agg(
            F.min("first").alias("first"), F.min(F.when(F.col("upto") > F.col("most"), F.col("nth"))).alias("stop"),
            F.coalesce(F.max(F.when(F.col("upto") <= F.col("most"), F.col("upto"))), F.lit(0)).alias("met"),
            (F.count("sum") == 0).alias("one"))
        # a row a source; without a text that fits, the columns of the walk are null
        walk = materialize(by_source(state, walk, "left"), "mix-walk")
        if walk.filter("one IS NOT NULL").isEmpty():
            break
        # the block in which the walk ends, one a source, text by text
        upto = F.sum("words").over(Window.partitionBy("s").orderBy("h2", "h1"))
        ends = unused(walk).filter(small & (F.col("nth") == F.col("stop"))).withColumn("upto", upto)
        ends = (ends.filter(F.col("met") + F.col("upto") <= F.col("left"))
                .groupBy("s").agg(F.max(here).alias("at"), F.max("upto").alias("more")))
        step = by_source(walk.withColumn("stepped", F.col("one").isNotNull()), ends, "left")
        rule = F.struct((F.col("left") / 2).alias("cap"),
                        F.when(F.col("one"), F.col("first.nth").cast("bigint")).otherwise(F.col("stop").cast("bigint")).alias("stop"),
                        F.when(F.col("one"), F.struct("first.h2", "first.h1")).otherwise(F.col("at")).alias("at"),
                        F.col("one").alias("one"))
        got = F.when(F.col("one"), F.col("first.words")).otherwise(F.col("met") + F.coalesce("more", F.lit(0)))
        state = materialize(step.select(
            "s", F.when(F.col("stepped"), F.col("left") - got).otherwise(F.col("left")).alias("left"),
            F.when(F.col("stepped"), F.concat("rules", F.array(rule).cast(kind))).otherwise(F.col("rules")).alias("rules")),
            "mix-left")
    taken = by_source(units, state, "inner").filter(F.exists("rules", by_rule))
    return materialize(taken.select("s", "h1", "h2"), "mix-fills")


def plan(rows: DataFrame, shards: int, n_blocks: int, seed: int = SEED, **options) -> tuple[DataFrame, DataFrame]:
    """(blocks, fills). ``blocks``: one row per (source, block), at most ``n_blocks`` a source: what
    every document of the block gets. ``fills``: the texts taken by ``fill``.

    ``passes`` whole passes; one more for all documents (``whole``), for those with h2 up to
    ``cut`` (the block in which the rest first ends) and for the texts in ``fills``.
    ``block_shards``: the shard of each pass over the block.
    """
    spark = rows.sparkSession
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    t = targets(rows, **options).withColumn("passes", passes.cast("long"))
    t = t.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")).withColumnRenamed("source", "s")
    blocks = rows.groupBy("source", F.pmod("h1", F.lit(n_blocks)).alias("block")).agg(F.sum("size").alias("words"))
    order = Window.partitionBy("s").orderBy(F.xxhash64(F.lit(seed + 2), "s", "block"), "block")
    used = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    b = (blocks.join(t, F.col("source").eqNullSafe(F.col("s"))).drop("source")
         .withColumn("nth", F.row_number().over(order) - 1)
         .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("s")))
         .withColumn("open", F.col("rest") - used)
         .withColumn("whole", F.col("words") <= F.col("open"))
         .withColumn("last", ~F.col("whole") & (F.col("open") > 0)))
    b = materialize(b, "mix-blocks")

    # the block in which a rest ends: one a source, documents in hash order until it is met
    units = (rows.select(F.col("source").alias("u"), "h1", "h2", "size", F.pmod("h1", F.lit(n_blocks)).alias("ub"))
             .join(b.select("s", "block", "nth", "open", "whole", "last"),
                   F.col("u").eqNullSafe(F.col("s")) & (F.col("ub") == F.col("block"))))
    texts = units.filter("last").groupBy("s", "h1", "h2").agg(F.sum("size").alias("words"), F.first("open").alias("open"))
    upto = F.sum("words").over(Window.partitionBy("s").orderBy("h2", "h1"))
    fits = texts.withColumn("upto", upto).filter(F.col("upto") <= F.col("open"))
    cuts = fits.groupBy("s").agg(F.max("h2").alias("cut"), F.max("upto").alias("met"))
    state = (b.filter("last").select("s", "open").join(cuts.withColumnRenamed("s", "cs"),
                                                       F.col("s").eqNullSafe(F.col("cs")), "left").drop("cs")
             .withColumn("left", F.col("open") - F.coalesce("met", F.lit(0)))
             .select(F.col("s").alias("ls"), "cut", "left"))
    state = materialize(state, "mix-cuts")
    spare = (units.join(state, F.col("s").eqNullSafe(F.col("ls")))
             .filter(~F.col("whole") & (~F.col("last") | F.col("cut").isNull() | (F.col("h2") > F.col("cut"))))
             .groupBy("s", "nth", "h1", "h2", "left").agg(F.sum("size").alias("words"))
             .filter((F.col("words") > 0) & (F.col("words") <= F.col("left"))).drop("left"))
    fills = fill(spare, state.select(F.col("ls").alias("s"), "left"))

    # block draws of each source: whole passes and the front of one more; their split among the shards
    draws = (b.groupBy("s").agg((F.first("passes") * F.first("n") + F.count_if(F.col("whole") | F.col("last"))).alias("q"))
             .orderBy(F.col("s").asc_nulls_last()).collect())
    quotas = np.array([r["q"] for r in draws], np.int64)
    counts = split_tree(quotas, shards, np.random.default_rng(seed)) if len(draws) else np.zeros((shards, 0), np.int64)
    bounds = [(r["s"], np.cumsum(counts[:, i]).tolist()) for i, r in enumerate(draws)]
    bounds = spark.createDataFrame(bounds, "bs string, bounds array<long>")

    out = (b.join(state.drop("left"), F.col("s").eqNullSafe(F.col("ls")), "left")
           .join(bounds, F.col("s").cast("string").eqNullSafe(F.col("bs"))))
    shard = F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes")), lambda p: F.least(
        F.size(F.filter("bounds", lambda x: x <= p * F.col("n") + F.col("nth"))), F.lit(shards - 1)))
    return out.select(F.col("s").alias("mix_source"), F.col("block").alias("mix_block"), "source_size", "target", "passes",
                      "whole", "last", "cut", shard.alias("block_shards")), fills


def apply_plan(docs: DataFrame, blocks: DataFrame, fills: DataFrame, n_blocks: int, shards: int) -> DataFrame:
    """``docs`` (with source, h1, h2) plus source_size, target, copies and the shard of each copy.

    The plan has at most ``n_blocks`` rows a source; it and the fills are broadcast if their measured
    size allows. A fill has no block draw, its shard is a hash.
    """
    blocks = materialize(blocks, "mix-plan")
    if fits_broadcast(blocks):
        blocks = F.broadcast(blocks)
    fills = fills.select(F.col("s").alias("fill_source"), F.col("h1").alias("f1"), F.col("h2").alias("f2"))
    if fits_broadcast(fills):
        fills = F.broadcast(fills)
    j = docs.join(blocks, F.col("source").eqNullSafe(F.col("mix_source"))
                  & (F.pmod("h1", F.lit(n_blocks)) == F.col("mix_block")), "left")
    j = j.join(fills, F.col("source").eqNullSafe(F.col("fill_source")) & (F.col("h1") == F.col("f1"))
               & (F.col("h2") == F.col("f2")), "left")
    cut = F.coalesce(F.col("last") & (F.col("h2") <= F.col("cut")), F.lit(False))
    drawn = F.col("passes") + (F.col("whole") | cut).cast("long")
    j = j.withColumn("copies", drawn + F.col("f1").isNotNull().cast("long"))
    by_draw = F.slice("block_shards", F.lit(1), drawn.cast("int"))
    by_hash = F.pmod(F.xxhash64(F.lit(SEED + 4), "h1", "h2"), F.lit(shards)).cast("int")
    j = j.withColumn("shards", F.when(F.col("f1").isNull(), by_draw).otherwise(F.concat(by_draw, F.array(by_hash))))
    return j.drop("mix_source", "mix_block", "passes", "whole", "last", "cut", "block_shards", "fill_source", "f1", "f2")


def mix_counts(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, shards for every document.

    Null and empty texts have size 0 and are taken with 0 words; a null source is a source of
    its own, the last by order; repeated rows share their fate; an empty table gives none.
    """
    rows = materialize(sized(docs), "mix-sizes")
    shards, n_blocks = layout(rows)
    out = apply_plan(rows, *plan(rows, shards, n_blocks, **options), n_blocks, shards)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "shards")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents themselves: every row once per copy, with its ``shard``, rows of a shard in
    random order. Columns of ``docs`` are kept."""
    kept = docs.columns
    rows = materialize(sized(docs), "mix-sizes")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), "source", *_hashes())
    shards, n_blocks = layout(rows)
    out = apply_plan(packed, *plan(rows, shards, n_blocks, **options), n_blocks, shards)
    out = (out.select("row", "h2", F.posexplode("shards").alias("copy", "shard"))
           .withColumn("place", F.xxhash64(F.lit(SEED + 3), "h2", "copy")))
    out = out.repartition("shard").sortWithinPartitions("shard", "place", "copy")
    return out.select(*[F.col("row")[c].alias(c) for c in kept], "shard")
