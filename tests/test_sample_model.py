"""B1-B4, M1-M14 on inline rows."""

import pytest
from pyspark.ml.stat import ChiSquareTest, Correlation
from pyspark.sql import functions as F

from hourglass.operators import model as M
from hourglass.operators import sample as B


def test_hash_sample_stable_across_partitioning(spark):
    base = spark.range(10_000).withColumnRenamed("id", "k")
    picks = []
    for n in (2, 8):
        picks.append(sorted(r.k for r in B.hash_sample(base.repartition(n), "k", 0.3, 123).collect()))
    assert picks[0] == picks[1]
    assert 2_700 < len(picks[0]) < 3_300


def test_balance_keeps_class_whole(spark):
    df = spark.range(5_000).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    out = B.balance_classes(df, "y", keep=1, fraction=0.1, seed=7, key="k")
    counts = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts[1] == 500
    assert 300 < counts[0] < 600
    native = B.balance_classes(df, "y", keep=1, fraction=0.1, seed=7, method="native")
    assert native.filter("y = 1").count() == 500


def test_hash_split_partitions_rows(spark):
    df = spark.range(2_000).withColumnRenamed("id", "k")
    train, test = B.train_test_split(df, (0.7, 0.3), 1823, key="k", method="hash")
    assert train.count() + test.count() == 2_000
    assert train.join(test, "k").count() == 0


def test_index_label_fixed_order(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (0,)], "y int")
    got = sorted({(r.y, r.label) for r in M.index_label(df, "y").collect()})
    assert got == [(0, 0.0), (1, 1.0)]
    only_ones = spark.createDataFrame([(1,)], "y int")
    assert M.index_label(only_ones, "y").first().label == 1.0
    fitted = M.index_label(df, "y", labels=None)
    assert sorted({(r.y, r.label) for r in fitted.collect()}) == [(0, 0.0), (1, 1.0)]


def test_auc_hard_is_balanced_accuracy(spark):
    pred = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0), (0.0, 0.0), (0.0, 1.0)],
                                 "label double, prediction double")
    assert M.auc_hard(pred).first().auc_hard == pytest.approx(0.75)
    assert M.eval_auc(pred) == pytest.approx(0.75)
    assert M.accuracy(pred).first().accuracy == pytest.approx(0.75)
    assert M.eval_accuracy(pred) == pytest.approx(0.75)


def test_correlation_matches_ml(spark):
    df = spark.range(200).select(
        (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5 * 1.5).cast("double").alias("b"),
        ((F.col("id") * 13) % 11).cast("double").alias("c"))
    ours = {(r.var_a, r.var_b): r.r for r in M.correlation_matrix(df, ["a", "b", "c"]).collect()}
    mat = Correlation.corr(M.assemble(df, ["a", "b", "c"]), "features").head()[0].toArray()
    names = ["a", "b", "c"]
    for i, x in enumerate(names):
        for j, y in enumerate(names):
            assert ours[(x, y)] == pytest.approx(mat[i][j], abs=1e-12)
    dense = M.correlation_dense(df, ["a", "b", "c"]).toArray()
    assert ours[("a", "c")] == pytest.approx(dense[0][2], abs=1e-12)
    const = df.withColumn("k", F.lit(1.0))
    assert {r.r for r in M.correlation_matrix(const, ["a", "k"]).collect() if "k" in (r.var_a, r.var_b)} == {None}


def test_chi_square_matches_ml(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("f"), (F.col("id") % 4).alias("g"),
                                 ((F.col("id") % 7) < 3).cast("int").alias("y"))
    ours = {r.feature: (r.statistic, r.dof) for r in M.chi_square(df, ["f", "g"], "y").collect()}
    data = M.index_label(M.assemble(df, ["f", "g"]), "y")
    ml = ChiSquareTest.test(data, "features", "label").head()
    assert ours["f"][0] == pytest.approx(ml.statistics[0], rel=1e-9)
    assert ours["g"][0] == pytest.approx(ml.statistics[1], rel=1e-9)
    assert (ours["f"][1], ours["g"][1]) == tuple(ml.degreesOfFreedom)
    pvals = M.chi_square_test(data).collect()
    assert len(pvals) == 2 and all(0.0 <= r.p_value <= 1.0 for r in pvals)


def test_models_fit_and_score(spark):
    df = spark.range(400).select(((F.col("id") % 10) / 10.0).alias("x1"),
                                 ((F.col("id") * 7 % 13) / 13.0).alias("x2"),
                                 ((F.col("id") % 10) >= 5).cast("int").alias("y"))
    data = M.index_label(M.assemble(df, ["x1", "x2"]), "y")
    train, test = data.randomSplit([0.7, 0.3], 1823)
    lr = M.fit_logistic(train, max_iter=50)
    assert M.eval_auc(M.score(lr, test)) > 0.9
    terms = dict(M.coefficients(lr, ["x1", "x2"]))
    assert set(terms) == {"intercept", "x1", "x2"} and terms["x1"] > 0
    mlr = M.fit_multinomial(train, max_iter=50)
    assert len(M.coefficient_matrix(mlr, ["x1", "x2"])) == 6
    nb = M.fit_naive_bayes(train)
    assert M.eval_accuracy(M.score(nb, test)) > 0.5
    rf = M.fit_random_forest(train, "y", trees=5)
    pred = M.score(rf, test)
    assert set(r.predictedLabel for r in pred.select("predictedLabel").distinct().collect()) <= {"0", "1"}
    idx = M.index_features(data, max_categories=10)
    assert set(idx.categoryMaps) <= {0, 1}
    back = M.label_to_string(M.score(lr, test), ["0", "1"]).select("predictedLabel").distinct().collect()
    assert {r.predictedLabel for r in back} <= {"0", "1"}


def test_hash_sample_survey_figure(spark):
    # the survey's independent check: 3,044 of ids 0..9,999 at fraction 0.3 (seed 1823)
    assert B.hash_sample(spark.range(10_000), "id", 0.3, 1823).count() == 3044


def test_rows_without_key_are_neither_dropped_nor_doubled(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("k"), (F.col("id") * 7).alias("v"),
                                  (F.col("id") % 2).alias("y"))
    assert B.hash_sample(df, "k", 1.0, 5).count() == 2000
    for method in ("md5", "xxhash64"):
        train, test = B.train_test_split(df, (0.7, 0.3), 5, key="k", method=method)
        assert train.count() + test.count() == 2000 and train.intersect(test).count() == 0
        assert 0.6 < train.filter("k is null").count() / 667 < 0.8
        kept = B.balance_classes(df, "y", keep=1, fraction=0.2, seed=5, key="k", method=method)
        assert kept.filter("y = 1").count() == 1000 and 120 < kept.filter("y = 0").count() < 280


def test_split_is_independent_of_balancing(spark):
    df = spark.range(20_000).select("id", F.lit(0).alias("y"))
    kept = B.balance_classes(df, "y", keep=1, fraction=0.05, seed=9, key="id")
    train, test = B.train_test_split(kept, (0.7, 0.3), 9, key="id", method="md5")
    assert test.count() > 0.2 * kept.count()
