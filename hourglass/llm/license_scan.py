"""License scan: an exact set-similarity join of text blocks with notice templates.

Blocks are the lines of a text, as sets of words. Template words are ordered by their
number of blocks over the whole corpus, rarest first. A block and a template meet when a
word of the template's prefix occurs in the block's prefix (containment ``threshold`` of the
template needs c = ceil(threshold * size) common words, so one of the first size - c + 1 is
common), the block has at least c template words (length filter) and enough words follow
on both sides (positional filter). Each pair is met at its first common word only and
verified once. DataFrame operations only; the template table is a constant of the
operator, which bounds its broadcast.

A notice wrapped over lines is found in its paragraph (lines up to one without words): the same
join proposes paragraphs, and a window of the template's length must hold the needed words in the
template's order (longest common subsequence, exact). Order is asked only across lines.

Base phrases are counted apart, by word positions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.session import materialize

THRESHOLD = 0.8
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLANK = r"\n(?:[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]*\n)+"  # lines without words end a paragraph

# Phrases and labels of the contract, and short public licence notices.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "gpl-3": "this work is licensed under the gnu general public license version 3",
    "lgpl": "licensed under the gnu lesser general public license",
    "mit": "released under the mit license",
    "mpl-2.0": "subject to the terms of the mozilla public license v 2 0",
    "public-domain": "this work has been released into the public domain",
}


def needed(size: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * size - 1e-9))


def vocabulary(templates: dict[str, str]) -> list[str]:
    return sorted({w for t in templates.values() for w in t.split()})


def read_once(docs: DataFrame, templates: dict[str, str], threshold: float | None = None) -> DataFrame:
    """The one scan of the texts, written as a narrow stage: doc_id, key2 (text hash), n_words, the
    base phrases' places (p0, p1, ...), blocks: the template words of every line that has any, and
    paragraphs: those of every paragraph of several lines with enough of them, with their places."""
    vocabulary_ = F.lit(vocabulary(templates)).cast("array<string>")
    fewest = min(needed(len(set(x.split())), THRESHOLD if threshold is None else threshold) for x in templates.values())
    d = docs.select("doc_id", F.xxhash64("text").alias("key2"), F.lower(F.coalesce("text", F.lit(""))).alias("t"))
    maybe = F.col("t").rlike("|".join(p.replace(" ", _GAP) for p in PHRASES))
    d = d.select("doc_id", "key2", "t", maybe.alias("maybe"), F.transform(
        F.split("t", "\n"), lambda line: F.regexp_extract_all(line, F.lit(WORD), 0)).alias("lines"))
    found = F.transform("lines", lambda line, i: F.struct(i.alias("block"), F.array_intersect(vocabulary_, line).alias("tokens")))
    d = d.select("doc_id", "key2", F.aggregate("lines", F.lit(0).cast("long"), lambda n, line: n + F.size(line)).alias("n_words"),
                 F.filter(found, lambda b: F.size(b["tokens"]) > 0).alias("blocks"),
                 F.when(F.col("maybe"), F.flatten("lines")).alias("w"), "t")
    places = [F.when(F.col("w").isNotNull(), _places("w", phrase)).alias(f"p{i}") for i, phrase in enumerate(PHRASES)]
    enough = F.size(F.array_distinct(F.flatten(F.col("blocks.tokens")))) >= fewest
    d = d.withColumn("paragraphs", F.when(enough & (F.size("blocks") > 1), _paragraphs("t", vocabulary_, fewest)))
    return materialize(d.select("doc_id", "key2", "n_words", "blocks", "paragraphs", *places), "license-words")


def _paragraphs(text: str, vocabulary_: Column, fewest: int) -> Column:
    """Array of (block, tokens, at): template words and their places in every paragraph of several lines."""
    parts = F.filter(F.split(text, BLANK), lambda p: F.contains(F.trim(p, F.lit("\n")), F.lit("\n")))

    def read(p: Column, i: Column) -> Column:
        w = F.transform(F.regexp_extract_all(p, F.lit(WORD), 0), lambda x, k: F.struct(k.alias("pos"), x.alias("w")))
        at = F.filter(w, lambda x: F.array_contains(vocabulary_, x["w"]))
        return F.struct((-1 - i).alias("block"), F.array_distinct(F.transform(at, lambda x: x["w"])).alias("tokens"), at.alias("at"))
    return F.filter(F.transform(parts, read), lambda b: F.size(b["tokens"]) >= fewest)


def blocks(read: DataFrame) -> DataFrame:
    """(key1, key2, block, tokens): one row per line that holds template words."""
    return read.select(F.col("doc_id").alias("key1"), "key2", F.inline("blocks"))


def frequency_order(read: DataFrame, templates: dict[str, str]) -> list[str]:
    """Template words by number of blocks over all documents, rarest first (one row a word to the driver)."""
    found = (blocks(read).select(F.explode("tokens").alias("w")).groupBy("w")
             .agg(F.count(F.lit(1)).alias("n")).collect())
    n = {r["w"]: r["n"] for r in found}
    return sorted(vocabulary(templates), key=lambda w: (n.get(w, 0), w))


def template_table(spark: SparkSession, templates: dict[str, str], order: list[str], threshold: float) -> DataFrame:
    """(label, template, size, need, token, t_pos, words, length) for every prefix word of every template."""
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for label, text in sorted(templates.items()):
        t = sorted(set(text.split()), key=rank.__getitem__)
        c = needed(len(t), threshold)
        in_order = list(dict.fromkeys(text.split()))
        rows += [(label, t, len(t), c, w, i, in_order, len(text.split())) for i, w in enumerate(t[:len(t) - c + 1])]
    return spark.createDataFrame(rows, "label string, template array<string>, size int, need int, token string, t_pos int, "
                                       "words array<string>, length int")


# The most words that a window of the template's length has in the template's order. Bit-parallel
# longest common subsequence: a state of one bit a word, a zero for each word of the subsequence.
_IN_ORDER = """array_max(transform(at, (first, i) -> size - bit_count(aggregate(
    filter(slice(at, i + 1, length), x -> x.pos < first.pos + length AND array_contains(words, x.w)),
    shiftleft(1L, size) - 1,
    (v, x) -> ((v + (v & shiftleft(1L, CAST(array_position(words, x.w) AS INT) - 1)))
               | (v - (v & shiftleft(1L, CAST(array_position(words, x.w) AS INT) - 1)))) & (shiftleft(1L, size) - 1)))))"""


def matches(read: DataFrame, templates: dict[str, str], threshold: float = THRESHOLD) -> DataFrame:
    """(key1, key2, block, label, overlap, containment) of every block and template that meet the threshold."""
    order = frequency_order(read, templates)
    table = F.broadcast(template_table(read.sparkSession, templates, order, threshold))
    fewest = min(needed(len(set(t.split())), threshold) for t in templates.values())
    ordered = F.array_intersect(F.lit(order).cast("array<string>"), "tokens")
    none = F.lit(None).cast("array<struct<pos:int,w:string>>")
    wrapped = read.filter("paragraphs IS NOT NULL").select(F.col("doc_id").alias("key1"), "key2", F.inline("paragraphs"))
    b = blocks(read).withColumn("at", none).unionByName(wrapped).withColumn("n", F.size("tokens")).filter(F.col("n") >= fewest).withColumn("tokens", ordered)
    prefix = F.slice("tokens", F.lit(1), F.col("n") - F.lit(fewest) + 1)
    pairs = b.select("*", F.posexplode(prefix).alias("b_pos", "token")).join(table, "token").filter(
        (F.col("n") >= F.col("need"))                                                        # length
        & (F.least(F.col("n") - F.col("b_pos"), F.col("size") - F.col("t_pos")) >= F.col("need")))  # position
    common = F.array_intersect("tokens", "template")
    pairs = pairs.withColumn("common", common).filter(F.get("common", F.lit(0)) == F.col("token"))  # once per pair
    pairs = pairs.withColumn("in_window", F.when(F.col("at").isNotNull(), F.expr(_IN_ORDER)))
    return (pairs.withColumn("overlap", F.coalesce(F.col("in_window").cast("int"), F.size("common"))).filter(F.col("overlap") >= F.col("need"))
            .select("key1", "key2", "block", "label", "overlap", (F.col("overlap") / F.col("size")).alias("containment")))


def _places(words: str, phrase: str) -> Column:
    parts = phrase.split()
    here = " AND ".join(f"get({words}, i + {k}) = '{w}'" for k, w in enumerate(parts))
    return F.expr(f"CASE WHEN size({words}) >= {len(parts)} THEN "
                  f"filter(sequence(0, size({words}) - {len(parts)}), i -> {here}) ELSE array() END")


def base_counts(read: DataFrame) -> DataFrame:
    """doc_id, key2, n_words, n_base, first_word, last_word, base (label array) per row."""
    every = F.concat(*[F.coalesce(f"p{i}", F.array().cast("array<int>")) for i in range(len(PHRASES))])
    labels = F.array_compact(F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(label))
                                       for i, label in enumerate(PHRASES.values())]))
    return read.select("doc_id", "key2", "n_words", F.size(every).cast("long").alias("n_base"),
                       F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
                       labels.alias("base"))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, labels and score of every row.

    Null and empty texts have no words and no labels ('' and score 0). Rows are told apart by
    (doc_id, text hash), so a null doc_id and repeated rows keep their own rows; an empty table
    gives none; other columns are ignored.
    """
    templates = TEMPLATES if templates is None else templates
    read = read_once(docs.select("doc_id", "text"), templates, threshold)
    found = (matches(read, templates, threshold).groupBy("key1", F.col("key2").alias("k2"))
             .agg(F.collect_set("label").alias("more"), F.max("containment").alias("best")))
    d = base_counts(read).join(found, F.col("doc_id").eqNullSafe(F.col("key1")) & (F.col("key2") == F.col("k2")), "left")
    both = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))))
    return d.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                    F.array_join(F.array_sort("base"), ",").alias("base_labels"),
                    F.array_join(both, ",").alias("labels"),
                    F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
