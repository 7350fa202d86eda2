import math
import random

import numpy as np
import pytest

from hourglass.llm import topk as T

SCHEMA = "vec_id long, embedding array<float>, label int, score string, v string, rank string"


def brute(rows, k, stride=20):
    ok = {(i, tuple(math.floor(64 * float(np.float32(x))) for x in v)) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, q in ok:
        if i % stride == 0:
            s = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i)[:k]
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 0, "x", "x", "x") for i, v in rows], SCHEMA)
    found = T.top_k(T.quantize(df), **options).select("query_id", "rank", "vec_id", "score")
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("blocks", [dict(), dict(block_rows=40, block_queries=3)])
def test_against_brute_force(spark, blocks):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    rows += [(i + 1000, [float(rng.choice([-1, 0, 1])) for _ in range(6)]) for i in range(60)]  # ties
    assert run(spark, rows, k=7, **blocks) == brute(rows, 7)


def test_invalid_and_repeated_vectors(spark):
    rows = [(0, [1.0, 2.0]), (20, None), (40, [1.0, None]), (60, [float("nan"), 1.0]), (80, [float("inf"), 1.0]),
            (None, [5.0, 5.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [0.0, 0.0]), (100, [0.0, 0.0])]
    assert run(spark, rows, k=20) == brute(rows, 20)
    assert run(spark, [(0, [1.0])], k=3) == [] and run(spark, [], k=3) == []


def test_walk_stops_early_and_is_exact():
    rng = np.random.default_rng(3)
    rows = np.floor(64 * rng.standard_normal((4000, 3)))
    lists = T.Lists(np.arange(4000), rows)
    scored = []
    for q in np.floor(64 * rng.standard_normal((20, 3))):
        ids, scores, n = lists.search(q[None], np.array([-1]), 5)[0]
        want = T.best(np.arange(4000), rows @ q, -1, 5)
        assert ids.tolist() == want[0].tolist() and scores.tolist() == want[1].tolist()
        scored.append(n)
    assert min(scored) < 1000


def test_zero_query_takes_smallest_ids():
    lists = T.Lists(np.arange(10), np.ones((10, 2)))
    ids, scores, _ = lists.search(np.zeros((1, 2)), np.array([0]), 3)[0]
    assert ids.tolist() == [1, 2, 3] and scores.tolist() == [0, 0, 0]


def test_score_to_beat_is_carried_into_other_blocks(spark):
    """Ties at the k-th score over many blocks in 64 dimensions, and clustered vectors whose far blocks stop early."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.choice([-1.0, 0.0, 1.0], 64)]) for i in range(120)]
    rows += [(200 + i, rows[i % 6][1]) for i in range(80)]
    assert run(spark, rows, k=9, block_rows=25, block_queries=4) == brute(rows, 9)
    lists = T.Lists(np.arange(2000), np.floor(64 * (rng.standard_normal((2000, 16)) * 0.05 - 1)))
    q = np.full(16, 64.0)
    ids, scores, scored = lists.search(q[None], np.array([-1]), 5, np.array([0.0]))[0]
    assert scored <= 2000 // 100 * 16 and (scores < 0).all()


def test_walks_that_meet_a_whole_block_are_sorted_once(monkeypatch):
    """Vectors of equal spread in 64 dimensions: the bound stops no walk, each takes some 30 steps."""
    calls, best = [], T.best
    monkeypatch.setattr(T, "best", lambda *a: calls.append(1) or best(*a))
    rng = np.random.default_rng(11)
    rows = np.floor(8 * rng.standard_normal((3000, 64)))
    ids, own = np.arange(3000), np.arange(40)
    lists = T.Lists(ids, rows)
    kth = np.array([best(ids, rows @ q, i, 5)[1][-1] for i, q in enumerate(rows[:40])])
    for floor in (None, kth - 50):
        calls.clear()
        for i, (found, scores, met) in enumerate(lists.search(rows[:40], own, 5, floor)):
            want = best(ids, rows @ rows[i], i, 5)
            assert found.tolist() == want[0].tolist() and scores.tolist() == want[1].tolist() and met == 3000
        assert len(calls) == 40


@pytest.mark.parametrize("seed", range(6))
def test_walk_stops_where_single_steps_would(seed):
    """The rows met are those of a walk that takes and judges one step at a time."""
    rng = np.random.default_rng(seed)
    n, d, k = int(rng.choice([40, 300, 1500])), int(rng.choice([1, 2, 3, 8])), 4
    rows = np.floor(64 * (rng.standard_normal((n, d)) * (0.05 if seed % 2 else 1) - seed % 2))
    ids, step = rng.permutation(2 * n)[:n], max(1, n // T.STEP_SHARE)
    order = np.argsort(rows, axis=0, kind="stable")
    queries = np.floor(64 * rng.standard_normal((10, d)))
    own = rng.choice(ids, 10)
    for floor in (np.full(10, -np.inf), np.array([np.sort(rows @ q)[-k - 1] for q in queries])):
        for i, (found, scores, met) in enumerate(T.Lists(ids, rows).search(queries, own, k, floor)):
            q, seen, depth, bound, beat = queries[i], set(), 0, np.inf, -np.inf
            while len(seen) < n and bound >= beat:
                depth = min(n, depth + step)
                bound = 0
                for j in range(d):
                    part = order[n - depth:, j] if q[j] > 0 else order[:depth, j]
                    seen |= set(part.tolist()) if q[j] else set()
                    bound += q[j] * (rows[part[0], j] if q[j] > 0 else rows[part[-1], j])
                met_rows = np.array(sorted(seen))
                top = T.best(ids[met_rows], rows[met_rows] @ q, own[i], k)
                beat = max(floor[i], top[1][-1] if len(top[1]) == k else -np.inf)
            kept = top[1] >= floor[i]
            assert met == len(seen)
            assert found.tolist() == top[0][kept].tolist() and scores.tolist() == top[1][kept].tolist()
