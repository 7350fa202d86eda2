import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.llm import mixing as M


def brute_targets(sizes):
    """Reshare step by step, as stated: sources by code point, null last."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, fixed, left = {}, set(), 1.5 * sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in free)
        share = {s: left * weight[s] / total for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s] + 1e-9]
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            fixed.add(s)
            left -= target[s]


def check(df):
    rows = df.select("doc_id", "text", "source").collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want = brute_targets(sizes)
    got = M.mix_counts(df).collect()
    assert len(got) == len(rows)
    key = lambda x: (x.doc_id is None, x.doc_id or 0)
    for r, g in zip(sorted(rows, key=key), sorted(got, key=key)):
        assert g.taken in (0, g.size, 2 * g.size)
    assert sorted(g.size for g in got) == sorted(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows)
    assert sorted({(g.source_size, round(g.target, 6)) for g in got}) == sorted({(sizes[s], round(want[s], 6)) for s in sizes})
    return got, want, sizes


def test_targets_and_taken(docs):
    got, want, sizes = check(docs)
    taken = defaultdict(int)
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    for g in got:
        taken[source[g.doc_id]] += g.taken
    for s, t in want.items():
        assert taken[s] <= t + 1e-6 and taken[s] >= 0.95 * t, (s, taken[s], t)


def test_reruns_and_layout_agree(docs):
    a = sorted((r.doc_id, r.taken, tuple(r.shards)) for r in M.mix_counts(docs).collect())
    b = sorted((r.doc_id, r.taken, tuple(r.shards)) for r in M.mix_counts(docs.repartition(7, "lang")).collect())
    assert a == b


def test_odd_rows(odd, empty):
    check(odd)
    assert M.mix_counts(empty).count() == 0
    out = M.mix(odd)
    assert out.columns == [*odd.columns, "shard"]
    assert M.mix(empty).count() == 0


def test_split_tree_adds_up_and_is_fair():
    rng = np.random.default_rng(1)
    quotas = np.array([1000, 10, 0, 333])
    counts = M.split_tree(quotas, 7, rng)
    assert (counts.sum(0) == quotas).all() and counts.shape == (7, 4) and (counts >= 0).all()
    assert abs(counts[:, 0] - 1000 / 7).max() < 30
    assert counts.sum(1).max() - counts.sum(1).min() <= 3


def test_copies_of_a_document_go_where_the_plan_says(docs, monkeypatch):
    monkeypatch.setattr(M, "layout", lambda rows: (8, 1024))
    counts = M.mix_counts(docs)
    mixed = M.mix(docs)
    assert mixed.count() == counts.agg(F.sum(F.size("shards"))).first()[0]
    per_shard = [r["count"] for r in mixed.groupBy("shard").count().collect()]
    assert len(per_shard) == 8 and min(per_shard) > 0.5 * max(per_shard)


def test_single_source_and_zero_sizes(spark):
    for rows in ([(1, "a b c", "s"), (2, "d e", "s")], [(1, "", "s"), (2, None, "t")], [(1, "a", None)]):
        check(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert pytest is not None
