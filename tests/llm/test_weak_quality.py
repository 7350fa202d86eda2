import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hourglass.llm import weak_quality as Q


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    g = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    many = Counter(g)
    covered = {j for i, x in enumerate(g) if many[x] > 1 for j in range(i, i + 5)}
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def check(df):
    rows = df.select("doc_id", "text").collect()
    got = Q.judge(df)
    assert Counter(tuple(r) for r in got.select("doc_id", *COLUMNS).collect()) == Counter((r.doc_id, *brute(r.text)) for r in rows)
    assert got.filter("base_failed AND kept").count() == 0


def test_counts_against_brute_force(docs):
    check(docs)


def test_odd_rows(odd, empty):
    check(odd)
    assert Q.judge(empty).count() == 0


def test_repeats_overlap_and_lines(spark):
    texts = ["a a a a a a a a", "a b c d e f a b c d e", "x\nx\n\nx \n x", "1 2 3 4 5 1 2 3 4", "a b c d e " * 3, "  \x0b é"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_separates_labelled_quality_without_labels(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    j = Q.judge(docs).join(labels, "doc_id")
    bad = j.filter("quality = 0")
    good = j.filter("quality = 1 AND NOT base_failed")
    assert bad.filter("NOT kept").count() / bad.count() > 0.9
    assert good.filter("kept").count() / good.count() > 0.97


def test_estimate_matches_posterior_columns(spark, docs):
    rows = Q.features(docs).select("*", *Q.votes())
    names = [f"vote_{r}" for r in Q.RULES]
    patterns = [(tuple(r[:-1]), r[-1]) for r in rows.groupBy(*names).count().collect()]
    shares, rates = Q.estimate(patterns)
    assert sum(shares) == pytest.approx(1)
    for r in rows.select(*names, Q.good_probability(shares, rates).alias("p")).distinct().collect():
        assert r.p == pytest.approx(Q.posterior(tuple(r[:-1]), shares, rates)[0])
    assert Q.estimate([])[0][0] == pytest.approx(Q.PRIOR)


def test_native_plan(docs):
    plan = Q.features(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert F.count is not None
