import random

import pytest

from hourglass.llm import common as C
from test_llm_common import plan


@pytest.fixture
def edges(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 130)]
    rows += [(i, 999) for i in range(200, 240)] + [(5, 5), (300, 301), (301, 300), (300, 301)]
    return spark.createDataFrame(rows, "a long, b long")


def rounds(monkeypatch, edges, small_edges):
    """Result of ``components`` and the plans that it writes; Spark makes no broadcast join unasked."""
    plans, write, spark = [], C.materialize, edges.sparkSession
    monkeypatch.setattr(C, "materialize", lambda df, name: (plans.append((name, plan(df))), write(df, name))[1])
    monkeypatch.setattr(C, "SMALL_EDGES", small_edges, raising=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return C.components(edges, "t"), plans
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rounds_over_few_edges_do_not_shuffle_for_their_joins(monkeypatch, edges):
    _, plans = rounds(monkeypatch, edges, 1 << 15)
    small = [p for name, p in plans if name == "t-small"]
    assert small and all("SortMergeJoin" not in p and "BroadcastHashJoin" in p for p in small)


def test_both_kinds_of_round_agree(monkeypatch, edges):
    few, _ = rounds(monkeypatch, edges, 1 << 15)
    few = sorted(map(tuple, few.collect()))
    monkeypatch.undo()
    many, plans = rounds(monkeypatch, edges, 0)
    assert all("SortMergeJoin" in p for name, p in plans if name == "t-small")
    assert few == sorted(map(tuple, many.collect())) and len(few) > 100


def test_the_groups_are_written_once(monkeypatch, edges):
    found, _ = rounds(monkeypatch, edges, 1 << 15)
    assert "Exchange" not in plan(found)
