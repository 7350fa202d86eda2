import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hourglass.llm import ngram_join as J

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def brute(rows, size=5, percent=75):
    """(doc_id, set size, smallest reachable id) per row."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return Counter((d, len(sets[i]), low.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows))


def check(df, **options):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in J.component_ids(df, **options).collect()) == brute(rows, *options.values())


def test_whole_table_against_brute_force(small_docs):
    check(small_docs)


def near_copies(n, seed, edits=4):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(50)}" for _ in range(120)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10_000)}"
        rows.append((i, " ".join(w[:rng.randint(90, 120)])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_group_of_near_copies_at_the_threshold(spark, seed):
    rows = near_copies(60, seed) + [(100 + i, t) for i, (_, t) in enumerate(near_copies(5, seed + 10))]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_small_sets_and_other_sizes(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(9)))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(df)
    check(df, size=2, percent=60)


def test_odd_rows(odd, empty):
    check(odd)
    assert J.component_ids(empty).count() == 0


def test_near_copies_do_not_emit_all_pairs(spark):
    rows = near_copies(200, 3, edits=2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _, groups, links = J.linked(df)
    assert groups.select("root").distinct().count() == 1
    assert links.count() < 20 * len(rows) < len(rows) * (len(rows) - 1) // 2


def test_keep_one_per_group(odd, small_docs, empty):
    for df in (odd, small_docs, empty):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        groups = {(n, c) for (d, n, c) in brute(rows) if n}
        alone = sum(k for (d, n, c), k in brute(rows).items() if not n)
        kept = J.keep_one(df)
        assert kept.columns == df.columns
        assert kept.count() == len({c for _, c in groups}) + alone


def test_positional_filter_keeps_pairs_at_the_bound(spark):
    # n = m = 7 with 6 common of 8 meets 75 % exactly
    rows = [(1, "a b c d e f g"), (2, "a b c d e f h"), (3, "z a b c d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(df, size=1, percent=75)
    assert J.needed(F.lit(7), F.lit(7), 75) is not None


def test_groups_join_over_several_rounds(spark, monkeypatch):
    """With one leader and one try a round, groups still join to the components of every link."""
    monkeypatch.setattr(J, "LEADERS", 1)
    monkeypatch.setattr(J, "TRIES", 1)
    monkeypatch.setattr(J, "MORE_TRIES", 2)
    rounds = []
    best = J._best_of_groups
    monkeypatch.setattr(J, "_best_of_groups", lambda rest, tries: rounds.append(tries) or best(rest, tries))
    rows = [(i, t) for k in range(3) for i, t in [(1000 * k + j, t) for j, (_, t) in enumerate(near_copies(70, 20 + k, edits=3))]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: shingles(t, 5) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    got = {r.doc_id: r.component_id for r in J.component_ids(df).collect()}
    assert got == {i: find(i) for i in sets} and len(rounds) > 1
