"""The penalized fit against plain numpy, ensembles against their own fits, shared searches."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskframe.functions.scalars import class_probability
from riskframe.operators import classifiers as C
from riskframe.operators import penalized, trees
from riskframe.schema import LABEL


def made(n: int = 400, width: int = 4, seed: int = 1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, width)), 3)
    x[:, -1] = 0.0  # a constant column
    y = (x[:, 0] - 0.5 * x[:, 1] + rng.normal(size=n) > 0.4).astype(int)
    return x, y, np.where(y == 1, 1.7, 0.6), np.arange(n) % 5


def table(spark, x, y, w, fold):
    rows = [(i, v.tolist(), int(t), float(a), int(f)) for i, (v, t, a, f) in enumerate(zip(x, y, w, fold))]
    df = spark.createDataFrame(rows, f"id long, x array<double>, {LABEL} int, weight double, fold int").repartition(3)
    return df.select("id", array_to_vector("x").alias("features"), LABEL, "weight", "fold").persist()


@pytest.fixture(scope="module")
def train(spark):
    return table(spark, *made())


def plain_l2(x, t, w, c):
    """Newton steps on the penalized loss, the constant a column like any."""
    x = np.column_stack((x, np.ones(len(x))))
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ b))
        b -= np.linalg.solve(np.eye(len(b)) + c * (x.T * (w * p * (1 - p))) @ x, b + c * x.T @ (w * (p - t)))
    return b


def test_squared_penalty_equals_numpy(train):
    x, y, w, fold = made()
    problems = [penalized.Problem(c, "l2", f) for c in (0.1, 1.0, 100.0) for f in (None, 2)]
    found = penalized.fit_many(train, problems, "features", LABEL, "weight", "fold")
    for problem, b in zip(problems, found):
        held = fold != (-1 if problem.without_fold is None else problem.without_fold)
        assert np.abs(b - plain_l2(x[held], y[held], w[held], problem.C)).max() < 1e-6


def test_absolute_penalty_is_optimal(train):
    """At the least value no slope exceeds the penalty, and it equals it where a coefficient is not zero."""
    x, y, w, _ = made()
    x = np.column_stack((x, np.ones(len(x))))
    for c in (0.01, 0.1, 10.0):
        (b,) = penalized.fit_many(train, [penalized.Problem(c, "l1")], "features", LABEL, "weight")
        slope = c * x.T @ (w * (1 / (1 + np.exp(-x @ b)) - y))
        assert np.abs(slope[b == 0]).max(initial=0) <= 1 + 1e-6
        assert np.abs(slope[b != 0] + np.sign(b[b != 0])).max(initial=0) < 1e-6
    assert b[3] == 0 and (penalized.fit_many(train, [penalized.Problem(1e-6, "l1")], "features", LABEL, "weight")[0] == 0).all()


def test_absolute_penalty_of_correlated_columns_takes_few_sweeps(monkeypatch):
    """Sweeps alone need thousands here; the point they lead to is solved for once its signs are found."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 1)) + 0.01 * rng.normal(size=(500, 6))
    curvature, slope, swept = 100 * x.T @ x, 100 * x.T @ rng.normal(size=500), []
    soft = penalized._soft
    monkeypatch.setattr(penalized, "_soft", lambda *a: swept.append(1) or soft(*a))
    b = rng.normal(size=6)
    out = b + penalized._step(penalized.Problem(1.0, "l1"), b, slope, curvature)
    pull = slope + curvature @ (out - b)
    assert np.abs(pull[out != 0] + np.sign(out[out != 0])).max() < 1e-6 and np.abs(pull[out == 0]).max(initial=0) <= 1 + 1e-6
    assert len(swept) <= 6 * 1000


def test_model_scores_and_is_stored(spark, train, tmp_path):
    x, y, w, _ = made()
    model = C.LOGISTIC.estimator().fit(train)
    b = plain_l2(x, y, w, 1.0)
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = penalized.PenalizedLogisticModel.load(str(tmp_path / "m"))
    rows = loaded.transform(train).select("id", class_probability("probability").alias("p"), "prediction").orderBy("id").collect()
    want = 1 / (1 + np.exp(-(x @ b[:-1] + b[-1])))
    assert np.abs(np.array([r.p for r in rows]) - want).max() < 1e-8
    assert [r.prediction for r in rows] == (want > 0.5).astype(float).tolist()


def test_no_rows(spark, train):
    b = penalized.fit_many(train.limit(0), [penalized.Problem(1.0, "l2")], "features", LABEL, "weight")
    assert (b[0] == 0).all()


def test_first_rounds_are_the_shorter_fit(spark, train):
    x, *_ = made()
    long, short = (GBTClassifier(labelCol=LABEL, maxIter=n, maxDepth=3, subsamplingRate=0.8, seed=5).fit(train) for n in (8, 3))
    found = trees.ensemble(spark, long, forest=False).boosted_scores(x, [3, 8])
    for k, model in enumerate((short, long)):
        rows = model.transform(train).select("id", class_probability("probability").alias("p")).orderBy("id").collect()
        assert np.abs(np.array([r.p for r in rows]) - found[:, k]).max() < 1e-9


def test_forest_arrays_score_as_the_forest(spark, train):
    x, *_ = made()
    model = RandomForestClassifier(labelCol=LABEL, weightCol="weight", numTrees=7, maxDepth=30, seed=5).fit(train)
    one = trees.ensemble(spark, model, forest=True)
    for least in (2, 10, 40):
        cut = trees.pruned(spark, model, least)
        rows = cut.transform(train).select("id", class_probability("probability").alias("p")).orderBy("id").collect()
        found = one.forest_scores(x, [7, 2], least)
        assert np.abs(np.array([r.p for r in rows]) - found[:, 0]).max() < 1e-9
        assert np.abs(one.leaf_values(x, least)[:, :2].mean(axis=1) - found[:, 1]).max() < 1e-12


def plain_tree(x, y, w, cuts):
    """Greedy tree by Gini over the given cuts, as (share of class 1, rows, split, low, high).

    Leaves of one parent that predict the same class are one leaf, as in the library.
    """

    def share(y, w):
        return w[y == 1].sum() / w.sum()

    def impurity(y, w):
        return 2 * share(y, w) * (1 - share(y, w))

    best = (1e-12, None, None)
    for j in range(x.shape[1]):
        for cut in cuts[j]:
            low = x[:, j] <= cut
            if low.any() and not low.all():
                parts = sum(w[s].sum() / w.sum() * impurity(y[s], w[s]) for s in (low, ~low))
                if impurity(y, w) - parts > best[0] + 1e-12:
                    best = (impurity(y, w) - parts, (j, cut), low)
    if best[1] is None:
        return share(y, w), len(x), None, None, None
    low, high = (plain_tree(x[s], y[s], w[s], cuts) for s in (best[2], ~best[2]))
    if low[2] is None and high[2] is None and (low[0] > 0.5) == (high[0] > 0.5):
        return share(y, w), len(x), None, None, None
    return share(y, w), len(x), best[1], low, high


def descend(node, row, least):
    while node[2] is not None and node[1] >= least:
        node = node[3] if row[node[2][0]] <= node[2][1] else node[4]
    return node[0]


@pytest.mark.parametrize("least", [2, 5, 20, 60])
def test_a_cut_tree_splits_no_node_below_the_bound(spark, least):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 6, size=(240, 3)).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 3) ^ (rng.random(240) < 0.15)).astype(int)
    w = np.where(y == 1, 1.31, 0.77)
    df = table(spark, x, y, w, np.zeros(240))
    model = RandomForestClassifier(
        labelCol=LABEL, weightCol="weight", numTrees=1, maxDepth=30, bootstrap=False, featureSubsetStrategy="all", seed=1
    ).fit(df)
    found = trees.ensemble(spark, model, forest=True).forest_scores(x, [1], least)[:, 0]
    tree = plain_tree(x, y, w, [np.arange(5) + 0.5] * 3)
    assert np.abs(found - [descend(tree, row, least) for row in x]).max() < 1e-9


def test_shared_search_equals_single_fits(spark, train):
    """A point's area on a fold is that of its own fit; forests of all trees and uncut boosting are the same fits."""
    grid = {"n_estimators": [4], "max_depth": [2, None], "min_samples_split": [2, 30], "min_samples_leaf": [1]}
    points = C.grid_points(grid)
    assert len(points) == 4 and len(C.grid_points(C.FOREST_GRID)) == 108 and len(C.grid_points(C.GBT_GRID)) == 54
    areas = C.fold_areas(train, C.FOREST, points, n_folds=5)
    assert len(areas) == 20
    for i in (0, 3):
        fit = C.FOREST.fit(train.filter("fold <> 1"), points[i])
        scores = C.predict(fit, train.filter("fold = 1"), "m")
        assert areas[i, 1] == pytest.approx(C.roc_auc(scores.withColumn("score", F.round("score", 12))).first()["roc_auc"], abs=1e-9)
    boosted = C.grid_points({"n_estimators": [2, 5], "subsample": [0.8], "max_depth": [3]})
    areas = C.fold_areas(train, C.GBT, boosted, n_folds=5)
    for i in (0, 1):
        fit = C.GBT.fit(train.filter("fold <> 4"), boosted[i])
        scores = C.predict(fit, train.filter("fold = 4"), "m")
        assert areas[i, 4] == pytest.approx(C.roc_auc(scores.withColumn("score", F.round("score", 12))).first()["roc_auc"], abs=1e-9)
    found = C.fit_tuned(train, C.LOGISTIC, {"C": [0.1, 10.0], "penalty": ["l1", "l2"]})
    assert found.params["C"] in (0.1, 10.0) and found.cv_roc_auc > 0.8
