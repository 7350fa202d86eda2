"""AUC by ranks, chi-square probabilities, exact class sizes and forests as tables."""

import math
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hourglass.operators import model as M
from hourglass.operators import sample as B


def plain_auc(rows):
    pos = [s for y, s in rows if y == 1.0 and s is not None]
    neg = [s for y, s in rows if y == 0.0 and s is not None]
    if not pos or not neg:
        return None
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("digits", [0, 1, 6])
def test_auc_by_ranks(spark, digits):
    rng = random.Random(digits)
    rows = [(float(rng.random() < 0.3), abs(round(rng.gauss(0, 1), digits))) for _ in range(700)] + [(1.0, None), (0.0, None)]
    df = spark.createDataFrame(rows, "label double, score double")
    r = M.auc_ranks(df, "score").first()
    assert r.auc == pytest.approx(plain_auc(rows), abs=1e-12)
    assert r.auc == pytest.approx(M.eval_auc(df.na.drop(), "score"), abs=1e-9)


def test_auc_of_a_hot_score_and_signed_zeros(spark):
    rows = [(float(i % 2), 0.5) for i in range(300)] + [(1.0, 0.0), (0.0, -0.0), (1.0, 0.9), (None, 0.7)]
    df = spark.createDataFrame(rows, "label double, score double")
    assert M.auc_ranks(df, "score").first().auc == pytest.approx(plain_auc(rows), abs=1e-12)


def test_auc_without_both_classes_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.2), (1.0, 0.4)], "label double, score double")
    assert tuple(M.auc_ranks(df, "score").first()) == (2, 0, None)
    assert tuple(M.auc_ranks(df.filter("label = 0"), "score").first()) == (0, 0, None)


def plain_p(statistic, dof):
    a, x = dof / 2, statistic / 2
    if dof == 0 or x <= 0:
        return 1.0
    n = int(x + 14 * math.sqrt(x) + 60 * math.sqrt(a) + 200)
    return 1 - math.fsum(math.exp(-x + (a + i) * math.log(x) - math.lgamma(a + i + 1)) for i in range(n))


def test_chi_square_probability(spark):
    rows = [(float(s), k) for k in (0, 1, 2, 3, 5, 10, 51, 400, 20_000)
            for s in (0.0, 1e-6, 0.1, 1.0, 3.84, k * 0.5, k * 0.95, k, k * 1.05, k * 1.5, k * 3.0)]
    got = spark.createDataFrame(rows, "statistic double, dof int").withColumn("p", M.chi_square_p()).collect()
    for r in got:
        assert r.p == pytest.approx(plain_p(r.statistic, r.dof), abs=1e-9), r


def test_chi_square_equals_the_library_and_goes_beyond_it(spark):
    rows = spark.range(3000).select((F.col("id") % 2).alias("y"), (F.col("id") * 7 % 5).cast("double").alias("a"),
                                    (F.col("id") * 31 % 97 % 11).cast("double").alias("b"))
    mine = {r.feature: r for r in M.chi_square_with_p(rows, ["a", "b"], "y").collect()}
    theirs = M.chi_square_test(M.index_label(M.assemble(rows, ["a", "b"]), "y")).collect()
    for r in theirs:
        own = mine["ab"[r.feature_index]]
        assert (own.dof, own.statistic) == (r.dof, pytest.approx(r.statistic, abs=1e-9))
        assert own.p_value == pytest.approx(r.p_value, abs=1e-9)
    many = spark.range(40_000).select((F.col("id") % 3 % 2).alias("y"), (F.col("id") % 15_000).alias("v"))
    r = M.chi_square_with_p(many, ["v"], "y").first()
    assert r.dof == 14_999 and r.p_value == pytest.approx(plain_p(r.statistic, r.dof), abs=1e-9)
    one = spark.createDataFrame([(1, 1.0), (1, 2.0)], "y int, v double")
    assert M.chi_square_with_p(one, ["v"], "y").first().p_value == 1.0


def classes(spark):
    return spark.range(9000).select("id", F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, "a").otherwise("b").alias("y"),
                                    F.lit("x").alias("_bucket_"))


def test_classes_cut_to_the_smallest(spark):
    df = classes(spark)
    out = B.balance_to_sizes(df, "y", 7, "id")
    assert out.columns == df.columns
    assert {r.y: r["count"] for r in out.groupBy("y").count().collect()} == {None: 900, "a": 900, "b": 900}
    again = B.balance_to_sizes(df.repartition(13), "y", 7, "id")
    assert {r.id for r in out.collect()} == {r.id for r in again.collect()}
    # the rows of the smallest hashes
    held = {r.id for r in out.filter("y = 'b'").collect()}
    by_hash = df.filter("y = 'b'").select("id", B.hash_bucket("id", 7).alias("h")).orderBy("h").limit(900).collect()
    assert held == {r.id for r in by_hash}


def test_classes_cut_to_given_sizes(spark):
    df = classes(spark)
    out = B.balance_to_sizes(df, "y", 7, "id", {"a": 123, "b": 0})
    assert {r.y: r["count"] for r in out.groupBy("y").count().collect()} == {None: 900, "a": 123}
    out = B.balance_to_sizes(df, "y", 7, "id", {"a": 10**9})
    assert out.count() == 9000
    assert B.balance_to_sizes(df.filter("id < 0"), "y", 7, "id").count() == 0


def test_rows_of_one_hash_stay_together(spark):
    df = spark.range(500).select(F.lit(1).alias("k"), F.lit("a").alias("y")).unionByName(
        spark.range(40).select(F.col("id").cast("int").alias("k"), F.lit("b").alias("y")))
    out = {r.y: r["count"] for r in B.balance_to_sizes(df, "y", 7, "k").groupBy("y").count().collect()}
    assert out == {"b": 40}  # 500 rows of one hash exceed 40


@pytest.mark.parametrize("seed", [1, 2])
def test_forest_as_tables(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.random(), float(rng.randrange(4)), rng.gauss(0, 1)) for i in range(600)]
    rows = [(*r, int(r[1] + (r[2] == 2) * 0.4 + rng.random() * 0.3 > 0.8)) for r in rows]
    df = M.assemble(spark.createDataFrame(rows, "id long, a double, c double, g double, y int"), ["a", "c", "g"])
    pipeline = M.fit_random_forest(df, "y", seed=seed)
    nodes = M.forest_nodes(pipeline.stages[2], spark)
    assert nodes.filter("categories IS NOT NULL").count() > 0 and nodes.filter("threshold IS NOT NULL").count() > 0
    assert nodes.select("tree").distinct().count() == 10
    scored = M.score(pipeline, df).select("id", "indexedFeatures", "prediction", vector_to_array("rawPrediction").alias("raw"))
    want = {r.id: (r.prediction, max(r.raw)) for r in scored.collect()}
    got = {r.id: (r.prediction, r.votes) for r in M.score_forest(nodes, scored.drop("prediction"), "id").collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 1e-9 for k in want)
