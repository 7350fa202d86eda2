import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hourglass.llm import common as C


def test_substring_hash_does_not_depend_on_place():
    h = C.SubstringHash(3)
    data = np.frombuffer(b"xxabcabcyyabc", np.uint8)
    p = h.prefix(data)
    at = np.array([2, 5, 10])
    assert len(set(h.of(p, at, at + 3).tolist())) == 1
    assert h.of(p, np.array([2]), np.array([4]))[0] != h.of(p, np.array([2]), np.array([5]))[0]


def test_text_buffer_and_slices():
    data, offsets = C.text_buffer(pa.array(["ab", None, "", "é"]).slice(0, 4))
    assert data.tobytes() == "abé".encode() and offsets.tolist() == [0, 2, 2, 2, 4]
    data, offsets = C.text_buffer(pa.array(["zz", "ab", None]).slice(1))
    assert data.tobytes() == b"ab" and offsets.tolist() == [0, 2, 2]
    assert list(C.slices(np.array([0, 5, 50, 51, 52]), 10)) == [(0, 1), (1, 2), (2, 4)]
    assert list(C.slices(np.array([0]), 10)) == []


def test_words_do_not_cross_texts():
    data, offsets = C.text_buffer(pa.array(["ab cd", "ef", "", " g"]))
    s, e, d = C.words(data, offsets, C.SPACES)
    assert [data[a:b].tobytes() for a, b in zip(s, e)] == [b"ab", b"cd", b"ef", b"g"]
    assert d.tolist() == [0, 0, 1, 3]


def test_bitmap_has_no_false_negative(spark):
    keys = spark.range(0, 5000).select((F.xxhash64("id")).alias("k")).unionByName(
        spark.sql("select cast(null as long) as k"))
    bits = C.bitmap(keys, "k")
    own = np.array([r.k for r in keys.filter("k is not null").collect()])
    assert C.in_bitmap(bits, own).all()
    assert C.in_bitmap(bits, np.random.default_rng(0).integers(-2**62, 2**62, 10_000)).mean() < 0.01
    assert not C.in_bitmap(C.bitmap(keys.limit(0), "k"), own).any()


def test_known_splits_rows_as_the_bitmap_does_without_python(spark):
    keys = spark.range(0, 3000).select(F.xxhash64("id").alias("k"))
    rows = spark.range(0, 9000).select(F.xxhash64("id").alias("k1"), F.col("id").alias("a.b"))
    own = np.array([r.k1 for r in rows.orderBy("`a.b`").collect()])
    want = set(np.flatnonzero(C.in_bitmap(C.bitmap(keys, "k"), own)).tolist())
    blocks = C.bitmap_blocks(keys, "k")
    found = C.known(rows, blocks, "k1")
    assert found.columns == rows.columns and "Python" not in plan(found) and "Arrow" not in plan(found)
    assert sorted(r["a.b"] for r in found.collect()) == sorted(want)
    assert {r["a.b"] for r in C.known(rows, blocks, "k1", inside=False).collect()} == set(range(9000)) - want
    assert C.known(rows, C.bitmap_blocks(keys.limit(0), "k"), "k1").count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_on_known_texts_need_no_worker_of_their_own(small_docs):
    """One Python step a stage: two would keep two workers a task, with the memory of both."""
    from hourglass.llm import ngram_join, suffix_dedup
    assert plan(suffix_dedup.removal_digest(small_docs)).count("MapInArrow") == 2  # rows without and with spans
    assert plan(suffix_dedup.remove_repeats(small_docs)).count("MapInArrow") == 2
    assert "MapInArrow" not in plan(ngram_join.keep_one(small_docs))


@pytest.mark.parametrize("shape", ["random", "chain", "star", "empty"])
def test_components_match_union_find(spark, shape):
    rng = random.Random(4)
    edges = {"random": [(rng.randrange(60), rng.randrange(60)) for _ in range(45)],
             "chain": [(i, i + 1) for i in range(40)], "star": [(i, 99) for i in range(40)], "empty": []}[shape]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    found = C.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert sorted((r.node, r.root) for r in found) == sorted((x, find(x)) for x in linked)
