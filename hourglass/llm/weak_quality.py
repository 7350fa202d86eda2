"""Quality by weak supervision (DataFrame operations only).

Rules look at counts of a whole text and vote good, bad or abstain. A text is good or
bad in one of a few ways. Expectation-maximisation over the vote patterns estimates, without
labels, how often each rule says bad of each of these kinds; the posterior probability of
"good" under these accuracies replaces an all-rules-must-pass filter. The patterns are counted by one pre-aggregated groupBy, at
most 3 ** rules rows, and the estimate runs on these counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
ROUNDS = 50
# Start values: share of good texts, and how often a voting rule says bad of good texts, of the
# kind of bad text it is made for, and of other kinds. The estimate moves all of them.
PRIOR = 0.85
MISFIRES, CATCHES, SPILLS = 0.01, 0.5, 0.1
PSEUDO_VOTES = 2.0            # weight of the start values in every estimate
LOWEST = 1e-4                 # bound of every estimated rate
KEEP_AT = 0.5

KINDS = ("good", "markup", "repetition", "shouting", "fragments")
# name -> (kind of bad text, good if, bad if) on the counts; neither: abstain
RULES = {
    "symbols": ("markup", "n_symbols <= 0.02 * word_chars", "n_symbols > 0.08 * word_chars"),
    "symbol_words": ("markup", "n_symbols <= 0.1 * n_words", "n_symbols > 0.4 * n_words"),
    "dup_lines": ("repetition", "n_dup_lines <= 0.1 * n_lines", "n_dup_lines > 0.3 * n_lines"),
    "repeats": ("repetition", "n_repeat_words <= 0.05 * n_words", "n_repeat_words > 0.2 * n_words"),
    "upper": ("shouting", "n_upper <= 0.1 * word_chars", "n_upper > 0.4 * word_chars"),
    "marks": ("shouting", "n_marks <= 0.05 * n_words", "n_marks > 0.3 * n_words"),
    "sentences": ("fragments", "n_stops >= 0.02 * n_words", "n_stops = 0 AND n_words >= 60"),
    "word_length": ("fragments", "word_chars >= 3 * n_words AND word_chars <= 9 * n_words",
                    "word_chars < 2.5 * n_words OR word_chars > 11 * n_words"),
}


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every whole text (null: none), one row each."""
    t = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    t = t.select("doc_id", "t", F.regexp_extract_all("t", F.lit(WORD), 0).alias("w"),
                 F.regexp_replace("t", r"[\x20\x09-\x0D]+", "").alias("dense"),
                 F.expr(r"filter(split(t, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')").alias("lines"))
    t = t.select("doc_id", "w", F.size("w").cast("long").alias("n_words"), _length("dense").alias("word_chars"),
                 *[(_length("dense") - F.length(F.regexp_replace("dense", p, ""))).cast("long").alias(n)
                   for n, p in (("n_symbols", SYMBOLS), ("n_upper", "[A-Z]+"), ("n_marks", "!+"),
                                ("n_stops", "[.?]+"))],
                 F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    # hashes of the word windows; positions are only worked out where two windows agree
    window = ", ".join(f"get(w, i + {k})" for k in range(WINDOW))
    t = t.withColumn("g", F.expr(f"CASE WHEN n_words > {WINDOW} THEN transform(sequence(0, int(n_words) - {WINDOW}), "
                                 f"i -> xxhash64({window})) END")).drop("w")
    t = t.withColumn("s", F.expr("CASE WHEN size(array_distinct(g)) < size(g) THEN "
                                 "array_sort(transform(g, (x, i) -> struct(x AS h, i AS i))) END")).drop("g")
    t = t.withColumn("p", F.expr("array_sort(transform(filter(s, (x, k) -> coalesce(get(s, k - 1).h = x.h, false) "
                                 "OR coalesce(get(s, k + 1).h = x.h, false)), x -> x.i))")).drop("s")
    covered = F.expr(f"aggregate(p, struct(0L AS n, {-WINDOW} AS last), (a, i) -> struct("
                     f"a.n + least({WINDOW}, i - a.last) AS n, i AS last), a -> a.n)")
    return t.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("p")


def _length(column: str) -> Column:
    return F.length(column).cast("long")


def votes() -> list[Column]:
    """1 good, 0 bad, null abstain."""
    return [F.when(F.expr(bad), 0).when(F.expr(good), 1).alias(f"vote_{name}") for name, (_, good, bad) in RULES.items()]


def estimate(patterns: list[tuple[tuple, int]], rounds: int = ROUNDS):
    """(shares of the kinds, rates[kind][rule] = P(vote bad | kind)) by expectation-maximisation over
    counted vote patterns. Pseudo-votes at the start values keep rules that never vote, and tables of
    few rows, in place."""
    kinds, rules = range(len(KINDS)), list(RULES.values())
    first = [PRIOR] + [(1 - PRIOR) / (len(KINDS) - 1)] * (len(KINDS) - 1)
    start = [[MISFIRES if c == 0 else CATCHES if rule[0] == KINDS[c] else SPILLS for rule in rules] for c in kinds]
    shares, rates = first, start
    for _ in range(rounds):
        mass = [PSEUDO_VOTES * x for x in first]
        bad = [[PSEUDO_VOTES * x for x in row] for row in start]
        voted = [[PSEUDO_VOTES] * len(rules) for _ in kinds]
        for pattern, n in patterns:
            for c, p in enumerate(posterior(pattern, shares, rates)):
                mass[c] += n * p
                for j, v in enumerate(pattern):
                    if v is not None:
                        voted[c][j] += n * p
                        bad[c][j] += n * p * (1 - v)
        shares = [x / sum(mass) for x in mass]
        rates = [[min(max(b / v, LOWEST), 1 - LOWEST) for b, v in zip(bs, vs)] for bs, vs in zip(bad, voted)]
    return shares, rates


def posterior(pattern, shares, rates) -> list[float]:
    """P(kind | votes)."""
    z = [math.log(share) + sum(math.log(1 - r if v else r) for v, r in zip(pattern, row) if v is not None)
         for share, row in zip(shares, rates)]
    e = [math.exp(x - max(z)) for x in z]
    return [x / sum(e) for x in e]


def good_probability(shares, rates) -> Column:
    """P(good | votes) as a column: 1 / (1 + sum over the bad kinds of their odds against good)."""
    odds = F.lit(1.0)
    for share, row in zip(shares[1:], rates[1:]):
        z = F.lit(math.log(share / shares[0]))
        for name, r, g in zip(RULES, row, rates[0]):
            vote = F.col(f"vote_{name}")
            z = z + F.when(vote == 1, math.log((1 - r) / (1 - g))).when(vote == 0, math.log(r / g)).otherwise(0.0)
        odds = odds + F.exp(z)
    return 1 / odds


def judge(docs: DataFrame) -> DataFrame:
    """Counts, base_failed, probability and kept for every row.

    Null and empty texts have zero counts and fail the base; a null doc_id and repeated rows keep
    their rows; an empty table gives none; other columns are ignored.
    """
    names = [f"vote_{r}" for r in RULES]
    rows = materialize(features(docs).select("*", *votes()), "quality-votes")
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = sorted(((tuple(r[:-1]), r[-1]) for r in counted), key=str)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = rows.withColumn("base_failed", failed).withColumn("probability", good_probability(*estimate(patterns)))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= KEEP_AT))
