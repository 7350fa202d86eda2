"""Exact Jaccard self-join of documents on word n-grams, and its connected groups.

1. The documents that hold an n-gram are counted in a fixed number of hash buckets; the counts
   define the global order (rarest bucket first, then hash). Any order gives the same links, this
   one keeps passages of many documents out of the prefixes: with 4 million buckets, and
   a few hundred n-grams a document, a passage in one of 5,000 documents stands out from what
   else falls into its buckets at every size of the corpus, as both grow alike.
2. A set that meets the threshold with another shares an n-gram of both prefixes (the first
   n - ceil(t n) + 1 in this order). Documents of equal sets are one class and indexed once.
3. N-grams of a single class are left out.
4. Candidates are made in steps, so that a group of many near copies does not emit all its
   pairs: in a few rounds every class meets a few classes of each of its n-grams, others each round,
   is compared with those that share most of its prefix, and the links found join the groups. Then all pairs of classes that are
   still in different groups are listed and every group tries its best few, more each round; a link joins two
   groups and closes all pairs between them, so that only pairs of groups that never link are compared to the last one.
   ``all_links`` adds the other pairs inside the groups.
   Length, positional and suffix filters (the overlap possible in parts of the hash
   space) apply to both; a pair is verified once.
5. Verification computes exact overlaps. The sets of candidates only are cut from the
   texts again and dealt by the pairs' first class, split where it has many partners.

Groups are the connected components of the links. N-grams and sets are known by 64-bit
hashes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.llm.common import (LOWER, SPACES, SubstringHash, bitmap, bitmap_blocks, components, import_path, in_bitmap, known,
                                  map_arrow, mix, slices, text_buffer, words)
from hourglass.operators.joins import fits_broadcast
from hourglass.session import materialize

WORDS = 5
PERCENT = 75               # Jaccard threshold in percent
FREQUENCY_BUCKETS = 1 << 22  # 4 MiB of ranks, whatever the corpus
FREQUENCY_BLOCKS = 1 << 10
PARTS = 16                 # of the hash space, for the suffix filter
LEADER_ROUNDS = 1          # more rounds leave fewer pairs to the last step but write more stages
LEADERS = 8                # classes of each n-gram that the others meet in a round
TRIES = 8                  # of these, compared with a class: those that share most of its prefix
MORE_TRIES = 4             # times as many pairs of a group in every further round
PARTNERS = 512             # sets compared with one class in one group
PAIRS_A_BUCKET = 1000
_HASH = SubstringHash(101)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def ngrams(data: np.ndarray, offsets: np.ndarray, size: int = WORDS):
    """(document, hash) of every run of ``size`` lower-cased words; the whole of a shorter text is one."""
    low = LOWER[data]
    start, end, doc = words(low, offsets, SPACES)
    w = _HASH.of(_HASH.prefix(low), start, end)
    m = max(len(w) - size + 1, 0)
    g = w[:m]
    for k in range(1, size):
        g = mix(g * _ODD + w[k:m + k])
    inside = doc[:m] == doc[size - 1:]
    owner, g = doc[:m][inside], g[inside]
    count = np.bincount(doc, minlength=len(offsets) - 1)
    first = np.cumsum(count) - count
    short = []
    for n in range(1, size):
        d = np.flatnonzero(count == n)
        h = np.full(len(d), n, np.uint64)
        for k in range(n):
            h = mix(h * _ODD + w[first[d] + k])
        short.append((d, h))
    owner = np.concatenate([owner, *[d for d, _ in short]])
    return owner, np.concatenate([g, *[h for _, h in short]])


def ngram_sets(data: np.ndarray, offsets: np.ndarray, size: int = WORDS):
    """(document, hash) sorted by both, without repeats."""
    doc, g = ngrams(data, offsets, size)
    order = np.lexsort((g, doc))
    doc, g = doc[order], g[order]
    fresh = np.ones(len(g), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (g[1:] != g[:-1])
    return doc[fresh], g[fresh]


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, a 128-bit key of (doc_id, text), and the text."""
    keys = [F.xxhash64(F.lit(n), "doc_id", "text").alias(f"k{n}") for n in (1, 2)]
    return docs.select("doc_id", *keys, F.coalesce("text", F.lit("")).alias("_text"))


def frequencies(texts: DataFrame, size: int) -> np.ndarray:
    """Documents that hold an n-gram, per hash bucket and as a rank of one byte (16 steps an octave).

    A task counts in an array of fixed size and sends it in blocks; the blocks of one number meet in one
    task, which adds them up as they come. Nothing depends on the number of n-grams or tasks but time.
    """
    per_block = FREQUENCY_BUCKETS // FREQUENCY_BLOCKS

    def count(batches):
        total = np.zeros(FREQUENCY_BUCKETS, np.uint32)
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            seen = []
            for lo, hi in slices(offsets):
                _, g = ngram_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], size)
                seen.append((g % np.uint64(FREQUENCY_BUCKETS)).astype(np.uint32))
            if seen:
                at, n = np.unique(np.concatenate(seen), return_counts=True)
                total[at] += n.astype(np.uint32)
        total = np.minimum(total, 0xFFFF).astype("<u2").reshape(FREQUENCY_BLOCKS, per_block)
        used = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([total[i].tobytes() for i in used], pa.binary())],
                                         ["block", "n"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                n = np.frombuffer(raw.as_buffer(), "<u2")
                if block in sums:
                    sums[block] += n
                else:
                    sums[block] = n.astype(np.float64)
        ranks = [np.minimum(np.log2(n + 1) * 16, 255).astype(np.uint8).tobytes() for n in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(ranks, pa.binary())], ["block", "n"])
    blocks = map_arrow(texts.select("_text"), count, "block int, n binary").repartition("block")
    out = np.zeros((FREQUENCY_BLOCKS, per_block), np.uint8)
    for r in map_arrow(blocks, add, "block int, n binary").collect():
        out[r["block"]] = np.frombuffer(bytes(r["n"]), np.uint8)
    return out.reshape(-1)


def prefix_size(n, percent: int):
    return n - (percent * n + 99) // 100 + 1


def prefixes(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """One row per document: doc_id, k1, k2, n, cid (hash of the set, null if empty), grams (its
    prefix in global order), parts (set sizes by part of the hash space)."""
    counts = texts.sparkSession.sparkContext.broadcast(frequencies(texts, size))
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(3))
            for lo, hi in slices(offsets):
                docs = hi - lo
                doc, g = ngram_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], size)
                n = np.bincount(doc, minlength=docs)
                first = np.cumsum(n) - n
                some = n > 0
                cid = np.zeros(docs, np.uint64)
                if some.any():
                    cid[some] = mix(np.add.reduceat(mix(g + np.uint64(1)), first[some]) + n[some].astype(np.uint64))
                order = np.lexsort((g, counts.value[(g % np.uint64(FREQUENCY_BUCKETS)).astype(np.int64)], doc))
                p = np.where(some, prefix_size(n, percent), 0)
                kept = np.arange(len(g)) - first[doc] < p[doc]
                parts = np.bincount(doc * PARTS + (g >> np.uint64(60)).astype(np.int64), minlength=docs * PARTS)
                ends = np.concatenate([[0], np.cumsum(p)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(lo, docs) for i in range(3)], pa.array(n.astype(np.int32)),
                     pa.array(cid.view(np.int64), mask=~some),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(g[order][kept].view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, docs * PARTS + 1, PARTS, dtype=np.int32)),
                                              pa.array(parts.astype(np.int32)))],
                    ["doc_id", "k1", "k2", "n", "cid", "grams", "parts"])
    return map_arrow(texts, run, f"doc_id {kind}, k1 long, k2 long, n int, cid long, grams array<long>, parts array<int>")


def index_rows(rows: DataFrame) -> DataFrame:
    """(g, cid, n, pos) of the prefix n-grams that more than one class has.

    An n-gram's rows are counted first and joined back, so a frequent one is pre-summed and its
    rows can be split among tasks.
    """
    grams = rows.filter("n > 0").select("cid", "n", F.posexplode("grams").alias("pos", "g"))
    repeated = materialize(grams.groupBy("g").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("g"), "ngram-repeated")
    return materialize(grams.join(repeated, "g").select("g", "cid", "n", "pos").distinct(), "ngram-index")


def needed(n: Column, m: Column, percent: int) -> Column:
    """Least overlap of sets of n and m that meet the threshold."""
    return F.ceil((n + m) * F.lit(percent) / F.lit(100 + percent))


def may_link(percent: int) -> Column:
    """Length and positional filter on two index rows of one n-gram (columns n, pos and m, mpos)."""
    n, m = F.col("n"), F.col("m")
    rest = F.least(n - F.col("pos"), m - F.col("mpos"))  # the shared n-gram and what can follow it
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (rest >= needed(n, m, percent))


def suffix_filter(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Drop pairs whose parts cannot add up to the overlap they need."""
    c = classes.select("cid", "n", "parts")
    both = (pairs.join(c.select(F.col("cid").alias("a"), F.col("n").alias("an"), F.col("parts").alias("ap")), "a")
            .join(c.select(F.col("cid").alias("b"), F.col("n").alias("bn"), F.col("parts").alias("bp")), "b"))
    most = F.aggregate(F.zip_with("ap", "bp", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    return both.filter(most >= needed(F.col("an"), F.col("bn"), percent)).select("a", "b")


def verify(pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that meet the threshold, by exact overlap of their sets."""
    spark = pairs.sparkSession
    import_path(spark)
    pairs = materialize(pairs, "ngram-pairs")
    groups = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("splits"))
    buckets = max(1, -(-pairs.count() // PAIRS_A_BUCKET))
    bucket = F.pmod(F.xxhash64("a", F.pmod(F.xxhash64("b"), F.col("splits"))), F.lit(buckets))
    pairs = pairs.join(groups, "a").select("a", "b", bucket.alias("bucket"))
    ends = pairs.select("bucket", F.explode(F.array("a", "b")).alias("cid"))
    to = (ends.distinct()
          .join(classes.select("cid", "k1", "k2"), "cid"))
    to = materialize(to, "ngram-wanted")
    bits = spark.sparkContext.broadcast(bitmap(to, "k1"))

    def cut(batches):
        for batch in batches:
            hit = in_bitmap(bits.value, batch.column(1).to_numpy())
            part = batch.filter(pa.array(hit))
            data, offsets = text_buffer(part.column(3))
            for lo, hi in slices(offsets):
                doc, g = ngram_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], size)
                at = np.searchsorted(doc, np.arange(hi - lo + 1))
                raw = [g[x:y].tobytes() for x, y in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([part.column(1).slice(lo, hi - lo), part.column(2).slice(lo, hi - lo),
                                                  pa.array(raw, pa.binary())], ["k1", "k2", "grams"])
    sets = map_arrow(texts, cut, "k1 long, k2 long, grams binary")
    dealt = sets.join(F.broadcast(to) if fits_broadcast(to) else to, ["k1", "k2"]).select(
        F.col("bucket").alias("to"), F.col("cid").alias("member"), "grams")

    def compare(pairs_: pa.Table, sets_: pa.Table) -> pa.Table:
        members = {c: np.frombuffer(g, np.uint64) for c, g in zip(sets_["member"].to_pylist(), sets_["grams"].to_pylist())}
        out = []
        for a, b in zip(pairs_["a"].to_pylist(), pairs_["b"].to_pylist()):
            x, y = members[a], members[b]
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                out.append((a, b))
        a, b = zip(*out) if out else ((), ())
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    links = materialize(pairs.groupBy("bucket").cogroup(dealt.groupBy("to")).applyInArrow(compare, "a long, b long"),
                        "ngram-links")
    bits.destroy()  # else the driver keeps one of each call
    return links


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _leaders(rows: DataFrame, turn: int, percent: int) -> DataFrame:
    """(g, y, m, mpos, yr): up to ``LEADERS`` classes of every n-gram.

    Half of them are those with the fewest prefix n-grams of their own: a text that its near copies
    were made from shares nearly all of its n-grams, and links with those that do not link with each
    other. The number is exact, as among many near copies only a few stand that close to all others. The other half can be any.
    """
    seat = F.struct(F.col("cid").alias("y"), F.col("n").alias("m"), F.col("pos").alias("mpos"), F.col("root").alias("yr"))
    in_prefix = F.max("n") - F.ceil(F.max("n") * F.lit(percent) / F.lit(100)) + 1
    rows = rows.join(rows.groupBy("cid").agg((in_prefix - F.count(F.lit(1))).cast("int").alias("rank")), "cid")
    picks = [F.min(F.struct((F.lit(0) if k % 2 else F.col("rank")).alias("rank"),
                            F.xxhash64(F.lit(turn * LEADERS + k), "cid").alias("h"), seat.alias("s"))) for k in range(LEADERS)]
    lead = rows.groupBy("g").agg(*[p["s"].alias(f"s{k}") for k, p in enumerate(picks)])
    lead = lead.select("g", F.explode(F.array_distinct(F.array(*[f"s{k}" for k in range(LEADERS)]))).alias("l"))
    return lead.select("g", "l.*")


def _mixed(index: DataFrame, groups: DataFrame) -> DataFrame:
    """Index rows with the root of their class, of n-grams whose classes are in different groups."""
    named = index.join(groups.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    named = materialize(named, "ngram-named")
    mixed = named.groupBy("g").agg((F.min("root") != F.max("root")).alias("mixed")).filter("mixed").select("g")
    return materialize(named.join(materialize(mixed, "ngram-open"), "g"), "ngram-mixed")


def _other(rows: DataFrame) -> DataFrame:
    return rows.select("g", F.col("cid").alias("y"), F.col("n").alias("m"), F.col("pos").alias("mpos"), F.col("root").alias("yr"))


def _cross(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b, ra, rb, shared): pairs of classes in different groups, their roots and how many prefix n-grams they share."""
    pairs = (rows.withColumnRenamed("cid", "x").join(_other(rows), "g")
             .filter("x < y AND root <> yr").filter(may_link(percent)))
    return pairs.groupBy(F.col("x").alias("a"), F.col("y").alias("b")).agg(
        F.min("root").alias("ra"), F.min("yr").alias("rb"), F.count(F.lit(1)).alias("shared"))


def _best_of_groups(rest: DataFrame, tries: int) -> DataFrame:
    """The ``tries`` pairs of every group that share most n-grams."""
    ends = rest.withColumn("end", F.explode(F.array("ra", "rb")))
    best = Window.partitionBy("end").orderBy(F.desc("shared"), "a", "b")
    ranked = ends.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= tries)
    return ranked.select("a", "b", "ra", "rb").distinct()


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


def _joined(groups: DataFrame, roots: DataFrame) -> DataFrame:
    """``groups`` (node, root) after groups were joined; ``roots`` (node, root) names the new root of an old one."""
    to = _small(roots.select(F.col("node").alias("root"), F.col("root").alias("to")))
    moved = groups.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return moved.unionByName(roots.join(groups.select("node"), "node", "left_anti"))


def _still_open(rest: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose classes are in different groups after the groups were joined, with their new roots."""
    for end in ("ra", "rb"):
        to = _small(roots.select(F.col("node").alias(end), F.col("root").alias("to")))
        rest = rest.join(to, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    return rest.filter("ra <> rb").select("a", "b", "ra", "rb", "shared")


class Connected(NamedTuple):
    texts: DataFrame    # doc_id, k1, k2, _text
    rows: DataFrame     # a row per document, with its prefix
    classes: DataFrame  # a row per distinct set
    index: DataFrame    # prefix n-grams of more than one class
    groups: DataFrame   # the root of every linked class (node, root)
    links: DataFrame    # verified links (a, b) that connect the groups
    tried: DataFrame    # pairs (a, b) of the leader rounds


def _connect(docs: DataFrame, size: int, percent: int) -> Connected:
    texts = keyed(docs)
    rows = materialize(prefixes(texts, size, percent), "ngram-prefixes")
    classes = materialize(rows.filter("n > 0").groupBy("cid").agg(
        F.min(F.struct("k1", "k2")).alias("key"), F.max("n").alias("n"), F.max("parts").alias("parts")).select(
        "cid", "key.*", "n", "parts"), "ngram-classes")
    index = index_rows(rows)
    links = tried = groups = None

    def check(pairs: DataFrame) -> DataFrame:
        nonlocal links, groups
        found = verify(suffix_filter(pairs, classes, percent), classes, texts, size, percent)
        links = found if links is None else links.unionByName(found)
        groups = components(links, "ngram-groups")
        return found

    # leader rounds: every class with a few classes of each n-gram, others each round
    open_rows = index.withColumn("root", F.col("cid"))
    for turn in range(LEADER_ROUNDS):
        lead = materialize(_leaders(open_rows, turn, percent), "ngram-lead")
        met = (open_rows.withColumnRenamed("cid", "x").join(lead, "g")
               .filter("x <> y AND root <> yr").filter(may_link(percent)).groupBy("x", "y").agg(F.count(F.lit(1)).alias("shared")))
        best = Window.partitionBy("x").orderBy(F.desc("shared"), "y")
        pairs = _ordered(met.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= TRIES))
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "ngram-leaders")
        tried = pairs if tried is None else tried.unionByName(pairs)
        n = pairs.count()
        found = check(pairs).count()
        # groups only grow, so an n-gram whose classes are all in one is never needed again
        open_rows = _mixed(open_rows.drop("root"), groups) if n else open_rows
        if found * 50 < n or n == 0:  # most of what is left does not link
            break

    # all pairs of one n-gram that are still in different groups: the best of every group, then more
    rest = materialize(_cross(open_rows, percent).join(tried, ["a", "b"], "left_anti"), "ngram-rest")
    tries, last = TRIES, False
    while not rest.isEmpty():
        pairs = rest.drop("shared") if last else materialize(_best_of_groups(rest, tries), "ngram-best-pairs")
        n = pairs.count()
        found = verify(suffix_filter(pairs.select("a", "b"), classes, percent), classes, texts, size, percent)
        links = links.unionByName(found)
        linking = found.count()
        if linking:
            edges = found.join(pairs, ["a", "b"]).select(F.col("ra").alias("a"), F.col("rb").alias("b"))
            roots = components(edges, "ngram-joined")
            groups = materialize(_joined(groups, roots), "ngram-groups")
        if last:
            break
        rest = rest.join(pairs, ["a", "b"], "left_anti")
        rest = materialize(_still_open(rest, roots) if linking else rest, "ngram-rest")
        tries, last = tries * MORE_TRIES, linking * 50 < n  # most of what is left does not link
    return Connected(texts, rows, classes, index, groups, links, tried)


def linked(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, groups, links): a row per document (doc_id, k1, k2, n, cid); the root of every
    linked class (cid, root); verified links (a, b) that connect the groups."""
    c = _connect(docs, size, percent)
    return c.rows.select("doc_id", "k1", "k2", "n", "cid"), c.groups.withColumnRenamed("node", "cid"), c.links


def all_links(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(documents, links): as ``linked``, with every link (a, b) of two classes, also inside a group.

    Classes of different groups are not linked, so what is left is pairs of one group that share
    a prefix n-gram and were not verified yet. An n-gram's classes are dealt to parts of about
    ``PARTNERS``; each part meets all of them. Work and output grow with the number of links.
    """
    c = _connect(docs, size, percent)
    named = materialize(c.index.join(c.groups.withColumnRenamed("node", "cid"), "cid"), "ngram-grouped")
    parts = named.groupBy("g", "root").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select(
        "g", "root", F.ceil(F.col("c") / PARTNERS).alias("splits"))
    dealt = materialize(named.join(parts, ["g", "root"]), "ngram-dealt")
    left = dealt.select("g", "root", F.col("cid").alias("x"), "n", "pos", F.pmod(F.xxhash64("cid"), F.col("splits")).alias("part"))
    right = dealt.select("g", "root", F.col("cid").alias("y"), F.col("n").alias("m"), F.col("pos").alias("mpos"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.col("splits") - 1)).alias("part"))
    pairs = _ordered(left.join(right, ["g", "root", "part"]).filter("x < y").filter(may_link(percent)))
    pairs = pairs.join(c.tried.unionByName(c.links), ["a", "b"], "left_anti")
    found = verify(suffix_filter(pairs, c.classes, percent), c.classes, c.texts, size, percent)
    return c.rows.select("doc_id", "k1", "k2", "n", "cid"), c.links.unionByName(found)


def link_counts(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, n_links (other rows that meet the threshold with it) for every row.

    Rows of equal sets are links of each other, repeated rows included; null and empty texts have none.
    """
    rows, links = all_links(docs, size, percent)
    held = materialize(rows.filter("n > 0").groupBy("cid").agg(F.count(F.lit(1)).alias("held")), "ngram-held")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = (both.join(held.withColumnRenamed("cid", "b"), "b").groupBy(F.col("a").alias("cid"))
              .agg(F.sum("held").alias("others")))
    n_links = held.join(others, "cid", "left").select("cid", (F.col("held") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return rows.join(n_links, "cid", "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                                                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def component_ids(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) for every row.

    Null and empty texts have an empty set and stand alone. Rows of equal sets are linked,
    repeated rows included; null ids are passed over by the smallest id and are null only where a
    group has no other; an empty table gives no row; other columns are ignored.
    """
    rows, groups, _ = linked(docs, size, percent)
    lowest = rows.filter("n > 0").groupBy("cid").agg(F.min("doc_id").alias("low"))
    # both written first: a join of two plain exchanges lets Spark split the root of a large group
    lowest = materialize(lowest.join(groups, "cid", "left").withColumn("root", F.coalesce("root", "cid")), "ngram-lowest")
    of_root = materialize(lowest.groupBy("root").agg(F.min("low").alias("component_id")), "ngram-roots")
    ids = lowest.join(of_root, "root").select("cid", "component_id")
    out = rows.join(ids, "cid", "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group: that of the smallest doc_id (of equal rows, one).

    Documents without words are all kept. Only rows that may go are shuffled with their text.
    """
    rows, groups, _ = linked(docs, size, percent)
    some = rows.filter("n > 0")
    best = (some.groupBy("cid").agg(F.min(F.struct("doc_id", "k1", "k2")).alias("best")).join(groups, "cid", "left")
            .withColumn("root", F.coalesce("root", "cid")))
    best = materialize(best, "ngram-best")  # as in component_ids
    of_root = materialize(best.groupBy("root").agg(F.min("best").alias("first")), "ngram-roots")
    best = best.drop("best").join(of_root, "root").withColumnRenamed("first", "best")
    rank = some.join(best.select("cid", F.col("best.k1").alias("b1"), F.col("best.k2").alias("b2")), "cid")
    gone = materialize(rank.filter("k1 <> b1 OR k2 <> b2").select("k1", "k2").distinct(), "ngram-gone")
    twice = some.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("k1", "k2")
    blocks = bitmap_blocks(gone.unionByName(twice), "k1")

    packed = docs.select(F.xxhash64(F.lit(1), "doc_id", "text").alias("k1"), F.xxhash64(F.lit(2), "doc_id", "text").alias("k2"),
                         *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns)])
    words_in = F.coalesce(F.col(f"_{docs.columns.index('text')}"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    maybe = known(packed, blocks, "k1").join(gone, ["k1", "k2"], "left_anti")
    maybe = maybe.filter(~words_in).unionByName(maybe.filter(words_in).dropDuplicates(["k1", "k2"]))
    return known(packed, blocks, "k1", inside=False).unionByName(maybe).select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])
