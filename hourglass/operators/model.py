"""Features, models and statistics (M1-M14) on ``pyspark.ml``.

Fitting and evaluation are distributed by ``pyspark.ml``. Statistics that SQL can
express (hard-label AUC, accuracy, Pearson correlations, chi-square statistic) are
also offered as DataFrame aggregates, computed in one pass each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    IndexToString,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.session import materialize


# --- features ----------------------------------------------------------------

def assemble(df: DataFrame, cols: Sequence[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """M1: columns to one vector. ``handle_invalid``: 'error', 'skip' or 'keep'."""
    return VectorAssembler(inputCols=list(cols), outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def index_label(df: DataFrame, col: str, out: str = "label",
                labels: Sequence[str] | None = ("0", "1")) -> DataFrame:
    """M2: label to a double index.

    With ``labels`` the mapping is fixed (``labels[i]`` -> i): 0 -> 0.0 and 1 -> 1.0
    even when the class frequencies flip or a class is absent from ``df``, and no
    fitting pass over the data is needed. ``labels=None`` fits a ``StringIndexer`` in
    alphabetical order.
    """
    if labels is not None:
        model = StringIndexerModel.from_labels(list(labels), inputCol=col, outputCol=out,
                                               handleInvalid="error")
    else:
        model = StringIndexer(inputCol=col, outputCol=out, stringOrderType="alphabetAsc").fit(df)
    return model.transform(df)


def index_features(df: DataFrame, col: str = "features", out: str = "indexedFeatures",
                   max_categories: int = 10):
    """M7: features with at most ``max_categories`` values become categorical."""
    return VectorIndexer(inputCol=col, outputCol=out, maxCategories=max_categories).fit(df)


def label_to_string(pred: DataFrame, labels: Sequence[str], col: str = "prediction",
                    out: str = "predictedLabel") -> DataFrame:
    """M8: index back to the original label."""
    return IndexToString(inputCol=col, outputCol=out, labels=list(labels)).transform(pred)


# --- models ------------------------------------------------------------------

def fit_logistic(train: DataFrame, max_iter: int = 150, reg: float = 0.02, elastic: float = 0.8,
                 family: str = "auto", features: str = "features", label: str = "label"):
    """M3 / M4: elastic-net logistic regression (``family='multinomial'`` for M4)."""
    return LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic,
                              family=family, featuresCol=features, labelCol=label).fit(train)


def fit_multinomial(train: DataFrame, **kw):
    """M4."""
    return fit_logistic(train, family="multinomial", **kw)


def fit_naive_bayes(train: DataFrame, features: str = "features", label: str = "label"):
    """M5: multinomial naive Bayes (features must be non-negative)."""
    return NaiveBayes(featuresCol=features, labelCol=label).fit(train)


def fit_random_forest(train: DataFrame, label_col: str, features: str = "features",
                      trees: int = 10, max_categories: int = 10, seed: int = 5043):
    """M6: label indexer + feature indexer + forest + label converter as one pipeline."""
    label_idx = StringIndexer(inputCol=label_col, outputCol="indexedLabel",
                              stringOrderType="alphabetAsc").fit(train)
    stages = [
        label_idx,
        VectorIndexer(inputCol=features, outputCol="indexedFeatures", maxCategories=max_categories),
        RandomForestClassifier(labelCol="indexedLabel", featuresCol="indexedFeatures",
                               numTrees=trees, seed=seed),
        IndexToString(inputCol="prediction", outputCol="predictedLabel", labels=label_idx.labelsArray[0]),
    ]
    return Pipeline(stages=stages).fit(train)


def score(model, df: DataFrame) -> DataFrame:
    """M12."""
    return model.transform(df)


# --- evaluation --------------------------------------------------------------

def eval_auc(pred: DataFrame, raw_col: str = "prediction", label: str = "label") -> float:
    """M9: area under ROC. On the hard ``prediction`` column this equals (TPR + TNR) / 2."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw_col,
                                         metricName="areaUnderROC").evaluate(pred)


def auc_hard(pred: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """M9 as one aggregate: (TPR + TNR) / 2 of hard 0/1 predictions."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    tp = F.count_if((y == 1.0) & (p == 1.0)).cast("double")
    pos = F.count_if(y == 1.0).cast("double")
    tn = F.count_if((y == 0.0) & (p == 0.0)).cast("double")
    neg = F.count_if(y == 0.0).cast("double")
    return pred.agg(((F.try_divide(tp, pos) + F.try_divide(tn, neg)) / F.lit(2.0)).alias("auc_hard"))


def score_ranks(pred: DataFrame, score: str, label: str = "label") -> DataFrame:
    """One row per distinct score (the null scores left out): ``pos`` and ``neg`` rows that have it, and
    ``neg_below``, the negatives with a lower score.

    Ties are pre-aggregated, so a score that a third of all rows share is one row. The distinct
    scores are dealt by range into a written stage; a part's rank offset is the sum of the parts
    before it, a table of one row per part; ranks inside a part are a window of that part alone.
    No task sees all scores.
    """
    y = F.col(label).cast("double")
    ties = pred.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.count_if(y == 1.0).alias("pos"), F.count_if(y == 0.0).alias("neg"))
    parts = materialize(ties.repartitionByRange("score").withColumn("part", F.spark_partition_id()), "score-ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per part
    starts = parts.groupBy("part").agg(F.sum("neg").alias("n")).select(
        F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = parts.withColumn("below", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
    return ranked.join(starts, F.col("part") == F.col("_part")).select(
        "score", "pos", "neg", (F.col("start") + F.col("below")).alias("neg_below"))


def auc_ranks(pred: DataFrame, score: str, label: str = "label") -> DataFrame:
    """M9 on raw scores, exact: (n_pos, n_neg, auc) with auc = share of (positive, negative) pairs in
    the right order, ties counting half. Null where a class is missing.

    ``BinaryClassificationEvaluator`` gives the same number where it keeps every score (it bins the
    curve of more than 1,000 distinct ones).
    """
    big = lambda c: F.col(c).cast("decimal(38,0)")  # noqa: E731  (twice the right pairs, kept whole)
    right = F.sum(F.col("pos").cast("decimal(18,0)") * (F.col("neg_below") * 2 + F.col("neg")).cast("decimal(20,0)"))
    sums = score_ranks(pred, score, label).agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"), F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"), right.alias("_right"))
    pairs = F.col("n_pos").cast("double") * F.col("n_neg").cast("double") * 2
    return sums.select("n_pos", "n_neg", F.try_divide(big("_right").cast("double"), pairs).alias("auc"))


def eval_accuracy(pred: DataFrame, prediction: str = "prediction", label: str = "label") -> float:
    """M10 (evaluator form)."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction,
                                             metricName="accuracy").evaluate(pred)


def accuracy(pred: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """M10 as one aggregate."""
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
    return pred.agg(F.avg(hit).alias("accuracy"))


def hard_metrics(pred: DataFrame) -> dict[str, float]:
    """M9 and M10 of hard predictions in one pass over ``pred``."""
    y, p = F.col("label").cast("double"), F.col("prediction").cast("double")

    def count(cond):
        return F.count_if(cond).cast("double")
    auc = (F.try_divide(count((y == 1.0) & (p == 1.0)), count(y == 1.0))
           + F.try_divide(count((y == 0.0) & (p == 0.0)), count(y == 0.0))) / F.lit(2.0)
    return pred.agg(auc.alias("auc_hard"), F.avg((y == p).cast("double")).alias("accuracy")).first().asDict()


def coefficients(model, names: Sequence[str] | None = None):
    """(term, value) pairs of a binary logistic model; bounded by the feature count."""
    coefs = model.coefficients.toArray().tolist()
    names = list(names or [f"x{i}" for i in range(len(coefs))])
    return [("intercept", float(model.intercept))] + list(zip(names, map(float, coefs)))


def coefficient_matrix(model, names: Sequence[str] | None = None):
    """M4 output: (class, term, value) of a multinomial model."""
    mat = model.coefficientMatrix.toArray()
    icp = model.interceptVector.toArray()
    names = list(names or [f"x{i}" for i in range(mat.shape[1])])
    rows = []
    for k in range(mat.shape[0]):
        rows.append((k, "intercept", float(icp[k])))
        rows += [(k, n, float(v)) for n, v in zip(names, mat[k])]
    return rows


# --- forests as tables -------------------------------------------------------

def forest_nodes(model, spark) -> DataFrame:
    """M6: the nodes of a fitted forest as rows (tree, node, feature, threshold, categories, left, right, shares).

    Splits: rows whose feature is at most ``threshold``, or among ``categories``, go left. Leaves have no
    feature; ``shares`` are the class shares of the training rows that reached them. A forest has
    at most trees x 2^(depth + 1) nodes, whatever the number of rows; they are built on the driver from the model.
    """
    rows = []
    for t, tree in enumerate(model.trees):
        todo = [tree._java_obj.rootNode()]
        at = 0
        while at < len(todo):
            node = todo[at]
            if node.numDescendants() == 0:
                stats = list(node.impurityStats().stats())
                total = sum(stats)
                rows.append((t, at, None, None, None, None, None, [v / total if total else 0.0 for v in stats]))
            else:
                split = node.split()
                children = []
                for child in (node.leftChild(), node.rightChild()):
                    children.append(len(todo))
                    todo.append(child)
                continuous = split.getClass().getSimpleName() == "ContinuousSplit"
                rows.append((t, at, split.featureIndex(), split.threshold() if continuous else None,
                             None if continuous else [float(c) for c in split.leftCategories()], *children, None))
            at += 1
    return spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, categories array<double>, "
                                       "left int, right int, shares array<double>")


def score_forest(nodes: DataFrame, df: DataFrame, key: str, features: str = "indexedFeatures", depth: int = 5) -> DataFrame:
    """M6, M12 as joins: (key, votes, prediction) of every row of ``df`` from the node table.

    Every row starts at the root of every tree and moves down one level per join with the nodes
    (bounded by the model, so broadcast); the class shares of the leaves are summed per row, pre-aggregated
    where the row is. Ties go to the smaller class. ``key`` must be unique.
    """
    n = F.broadcast(nodes)
    roots = F.broadcast(nodes.filter("node = 0").select("tree", "node"))
    state = df.select(key, vector_to_array(features).alias("_x")).join(roots)
    for _ in range(depth + 1):
        x = F.element_at("_x", F.col("feature") + 1)
        left = F.when(F.col("categories").isNotNull(), F.array_contains("categories", x)).otherwise(x <= F.col("threshold"))
        state = state.join(n, ["tree", "node"]).select(
            key, "_x", "tree", F.when(F.col("feature").isNull(), F.col("node")).when(left, F.col("left"))
            .otherwise(F.col("right")).alias("node"))
    leaves = state.join(n.select("tree", "node", "shares"), ["tree", "node"])
    votes = leaves.select(key, F.posexplode("shares").alias("class", "share")).groupBy(key, "class").agg(
        F.sum("share").alias("votes"))
    best = votes.groupBy(key).agg(F.max(F.struct(F.col("votes"), (-F.col("class")).alias("c"))).alias("best"))
    return best.select(key, F.col("best.votes").alias("votes"), (-F.col("best.c")).cast("double").alias("prediction"))


# --- statistics --------------------------------------------------------------

def pearson(a, b):
    """Pearson r over rows where both are present; null (not an error) when either
    side has zero variance. Built from mergeable population moments."""
    a = F.col(a).cast("double") if isinstance(a, str) else a
    b = F.col(b).cast("double") if isinstance(b, str) else b
    both = a.isNotNull() & b.isNotNull()
    am, bm = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(am, bm), F.sqrt(F.var_pop(am) * F.var_pop(bm)))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _pearson_sql(a: str, b: str) -> str:
    both = f"{_q(a)} IS NOT NULL AND {_q(b)} IS NOT NULL"
    x = f"CASE WHEN {both} THEN CAST({_q(a)} AS DOUBLE) END"
    y = f"CASE WHEN {both} THEN CAST({_q(b)} AS DOUBLE) END"
    return f"try_divide(covar_pop({x}, {y}), sqrt(var_pop({x}) * var_pop({y})))"


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair as a long table (var_a, var_b, r).

    All k*(k+1)/2 coefficients come from one aggregate (each a mergeable partial
    state), mirrored to the full k*k table. ``Correlation.corr`` gives the same
    matrix as a driver-side object. The expressions are written as SQL text (same
    plan as ``pearson``), which builds the plan with a few calls instead of hundreds.
    """
    cols = list(cols)
    pairs = [(a, b, f"c{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if j >= i]
    wide = df.agg(*[F.expr(_pearson_sql(a, b)).alias(name) for a, b, name in pairs])
    rows = []
    for a, b, name in pairs:
        rows.append(f"named_struct('var_a', {_lit(a)}, 'var_b', {_lit(b)}, 'r', {name})")
        if a != b:
            rows.append(f"named_struct('var_a', {_lit(b)}, 'var_b', {_lit(a)}, 'r', {name})")
    return wide.selectExpr(f"inline(array({', '.join(rows)}))")


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def correlation_dense(df: DataFrame, cols: Sequence[str]):
    """M13 as ``pyspark.ml`` gives it: a k x k ``DenseMatrix`` on the driver (k is the
    number of columns, not rows). Rows with a null in any column are skipped."""
    from pyspark.ml.stat import Correlation
    data = assemble(df, cols, handle_invalid="skip")
    return Correlation.corr(data, "features").head()[0]


def chi_square(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """M14 statistic: Pearson chi-square of each feature against the label.

    One pass builds the contingency counts of every (feature, value, label) cell
    (features are unpivoted, so each distinct value is a category; rows where a
    feature is null are left out of that feature's table). Expected counts need
    the row total of each (feature, value), a window over at most #labels cells,
    and the column totals per (feature, label), a table of #features x #labels rows
    joined back (broadcast at run time). No task ever holds all cells of a feature.
    Output: feature, statistic, degrees of freedom.
    """
    long = df.select(F.col(label).cast("string").alias("__y"),
                     F.explode(F.array(*[F.struct(F.lit(f).alias("feature"),
                                                  F.col(f).cast("double").alias("value"))
                                         for f in features])).alias("__kv"))
    cells = long.filter(F.col("__kv.value").isNotNull()).groupBy(
        F.col("__kv.feature").alias("feature"), F.col("__kv.value").alias("value"), "__y",
    ).agg(F.count(F.lit(1)).alias("o"))
    cells = materialize(cells, "chi-square-cells")  # used three times below
    cells = cells.withColumn("r", F.sum("o").over(Window.partitionBy("feature", "value")))
    col_tot = cells.groupBy("feature", "__y").agg(F.sum("o").alias("c"))
    n_tot = col_tot.groupBy("feature").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("n_labels"))
    framed = cells.join(col_tot, ["feature", "__y"]).join(n_tot, "feature")
    # sum((o - e)^2 / e) over all cells = sum(o^2 / e) - n, with e = r * c / n;
    # cells absent from the table have o = 0 and add nothing to the first sum.
    stats = framed.groupBy("feature").agg(
        F.sum((F.col("o") * F.col("o")).cast("double") * F.col("n") / (F.col("r") * F.col("c"))).alias("s"),
        F.max("n").alias("n"), F.max("n_labels").alias("n_labels"),
        F.count_distinct("value").alias("n_values"))
    return stats.select(
        "feature",
        (F.col("s") - F.col("n").cast("double")).alias("statistic"),
        ((F.col("n_values") - 1) * (F.col("n_labels") - 1)).cast("int").alias("dof"))


def log_gamma(a) -> Column:
    """ln gamma of a positive double column: the asymptotic series at a + 10, stepped down by the recurrence."""
    a = F.col(a) if isinstance(a, str) else a
    b = a + 10.0
    r = 1.0 / (b * b)
    # B(2k) / (2k (2k - 1)) of the series, k = 1 ... 8.
    terms = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360, 1 / 156, -3617 / 122400)
    tail = F.lit(0.0)
    for c in reversed(terms):
        tail = tail * r + c
    steps = F.lit(0.0)
    for k in range(10):
        steps = steps + F.log(a + float(k))
    return (b - 0.5) * F.log(b) - b + 0.9189385332046727 + tail / b - steps


def upper_gamma(a, x) -> Column:
    """Regularised upper incomplete gamma Q(a, x) of double columns a > 0, x >= 0, in built-in expressions.

    The power series of P = 1 - Q below x = a + 1, the continued fraction of Q (modified
    Lentz steps) above it; as many steps as the slower case x = a needs, a few times sqrt(a).
    """
    a = F.col(a) if isinstance(a, str) else a
    x = F.col(x) if isinstance(x, str) else x
    steps = F.sequence(F.lit(1), F.least(F.lit(60.0) + F.sqrt(a) * 12, F.lit(5e6)).cast("int"))
    front = F.exp(-x + a * F.log(x) - log_gamma(a))
    series = F.aggregate(
        steps, F.struct((1.0 / a).alias("term"), (1.0 / a).alias("total")),
        lambda s, n: F.struct((s["term"] * x / (a + n)).alias("term"), (s["total"] + s["term"] * x / (a + n)).alias("total")),
        lambda s: s["total"])

    def step(s, n):
        an, b = n * (a - n), x + 1.0 - a + 2.0 * n
        d = 1.0 / (an * s["d"] + b)
        c = b + an / s["c"]
        return F.struct(d.alias("d"), c.alias("c"), (s["h"] * d * c).alias("h"))
    first = 1.0 / (x + 1.0 - a)
    fraction = F.aggregate(steps, F.struct(first.alias("d"), F.lit(1e300).alias("c"), first.alias("h")), step, lambda s: s["h"])
    return (F.when(x <= 0.0, F.lit(1.0)).when(x < a + 1.0, F.greatest(F.lit(0.0), 1.0 - front * series))
            .otherwise(front * fraction))


def chi_square_p(statistic="statistic", dof="dof") -> Column:
    """Probability of a chi-square statistic at least as large; 1 without degrees of freedom."""
    s = F.col(statistic) if isinstance(statistic, str) else statistic
    k = F.col(dof) if isinstance(dof, str) else dof
    return F.when(k > 0, upper_gamma(k.cast("double") / 2.0, F.greatest(s, F.lit(0.0)) / 2.0)).otherwise(F.lit(1.0))


def chi_square_with_p(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """M14 whole: feature, statistic, dof, p_value; for any number of distinct values of a feature."""
    # computed once: the p-value reads the statistic many times
    return materialize(chi_square(df, features, label), "chi-square").withColumn("p_value", chi_square_p())


def chi_square_test(df: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """M14 with p-values through ``ChiSquareTest`` (vector column input)."""
    res = ChiSquareTest.test(df, features, label)
    each = F.posexplode(F.arrays_zip(vector_to_array("pValues").alias("p"), F.col("degreesOfFreedom").alias("d"),
                                     vector_to_array("statistics").alias("s"))).alias("feature_index", "x")
    return res.select(each).select("feature_index", F.col("x.p").alias("p_value"), F.col("x.d").alias("dof"),
                                   F.col("x.s").alias("statistic"))
