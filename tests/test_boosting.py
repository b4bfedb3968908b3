"""Boosting of many fits at once against ``pyspark.ml``'s, single fits and other layouts."""

from __future__ import annotations

import json
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskframe import queries
from riskframe.functions.scalars import class_probability
from riskframe.operators import boosting
from riskframe.operators import classifiers as C
from riskframe.schema import LABEL

FOLDS = 5


def made(n: int = 600):
    """Few values a column, so that both fits cut at the same places."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, size=(n, 3)).astype(float)
    y = (x[:, 0] + x[:, 1] * (x[:, 2] > 5) + 3 * rng.normal(size=n) > 9).astype(int)
    return x, y


def table(spark, parts: int):
    x, y = made()
    rows = [(i, v.tolist(), int(t), i % FOLDS) for i, (v, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, f"id long, x array<double>, {LABEL} int, fold int").repartition(parts, "id")
    return df.select("id", array_to_vector("x").alias("features"), LABEL, "fold").persist()


@pytest.fixture(scope="module")
def train(spark):
    return table(spark, 3)


def scores(model, df) -> np.ndarray:
    rows = model.transform(df).select("id", class_probability("probability").alias("p"), "prediction").orderBy("id").collect()
    assert all((r.p > 0.5) == (r.prediction == 1) for r in rows)
    return np.array([r.p for r in rows])


@pytest.mark.parametrize("depth", [1, 3])
def test_the_method_is_that_of_spark(spark, train, depth):
    settings = {"labelCol": LABEL, "maxIter": 12, "maxDepth": depth, "stepSize": 0.2, "subsamplingRate": 1.0, "seed": 5}
    want = scores(GBTClassifier(**settings).fit(train), train)
    assert np.abs(scores(boosting.Boosted(**settings).fit(train), train) - want).max() < 1e-6


def test_trees_do_not_depend_on_the_layout(spark, train):
    kinds = [boosting.Boosted(labelCol=LABEL, maxIter=7, maxDepth=3).fit(df).getOrDefault("trees") for df in (train, table(spark, 5))]
    assert kinds[0] == kinds[1]


def test_blocks_and_stored_rounds_change_nothing(spark, train, monkeypatch):
    fit = boosting.Boosted(labelCol=LABEL, maxIter=7, maxDepth=3, subsamplingRate=0.7)
    whole = json.loads(fit.fit(train).getOrDefault("trees"))
    for name, value in (("BLOCK_BYTES", 0), ("LEAST_ROWS", 37), ("KEPT_ROUNDS", 2), ("MOST_SENT", 0)):
        monkeypatch.setattr(boosting, name, value)
    parted = json.loads(fit.fit(train).getOrDefault("trees"))
    assert whole.keys() == parted.keys()
    for k in whole:
        assert whole[k] == pytest.approx(parted[k], abs=1e-6)


def test_fits_of_all_folds_share_their_jobs(spark, train):
    """One search has no more jobs than its rounds and levels ask for, however many points and folds."""
    points = C.grid_points({"n_estimators": [4], "learning_rate": [0.1, 0.2], "max_depth": [2], "subsample": [0.8, 1.0]})
    tracker, group = spark.sparkContext.statusTracker(), "shared-boosting"
    spark.sparkContext.setJobGroup(group, group)
    try:
        areas = C.fold_areas(train, C.GBT, points, n_folds=FOLDS)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(areas) == 4 * FOLDS and all(a > 0.5 for a in areas.values())
    assert len(tracker.getJobIdsForGroup(group)) < 60


def test_a_saved_model_scores_the_same(spark, train, tmp_path):
    model = boosting.Boosted(labelCol=LABEL, maxIter=5, subsamplingRate=0.8).fit(train)
    model.write().save(str(tmp_path / "m"))
    assert (scores(boosting.BoostedModel.load(str(tmp_path / "m")), train) == scores(model, train)).all()


def test_one_class_and_one_row(spark, train):
    for df in (train.filter(F.col(LABEL) == 0), train.limit(1)):
        model = boosting.Boosted(labelCol=LABEL, maxIter=3).fit(df.coalesce(1))
        assert len(set(scores(model, df))) == 1


def test_fits_in_tasks_are_those_of_jobs_a_level(spark, monkeypatch):
    """Same trees and scores whichever way fits are grown: rates, depths, shares, folds, a null fold, columns of many bins."""
    rng = np.random.default_rng(6)
    x = np.column_stack((rng.normal(size=500).round(2), rng.integers(0, 4, (500, 3)), np.ones(500)))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=500) > 2).astype(int)
    rows = [(i, v.tolist(), int(t), None if i == 7 else i % 3) for i, (v, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, f"id long, x array<double>, {LABEL} int, fold int").repartition(3, "id")
    df = df.select("id", array_to_vector("x").alias("features"), LABEL, "fold").persist()
    problems = [boosting.Problem(3, 0.3, d, s, f) for d, s, f in ((1, 1.0, 0), (4, 0.8, 1), (3, 0.6, 2), (4, 1.0, 1))]
    points = C.grid_points({"n_estimators": [2, 4], "max_depth": [3], "subsample": [0.8, 1.0]})
    own, areas = boosting.fit_many(df, problems, fold_col="fold", label=LABEL), C.fold_areas(df, C.GBT, points, n_folds=3)
    monkeypatch.setattr(boosting, "LOCAL_ROWS", 0)
    for name, value in (("BLOCK_BYTES", 0), ("LEAST_ROWS", 37), ("KEPT_ROUNDS", 2)):
        monkeypatch.setattr(boosting, name, value)
    for a, b in zip(own, boosting.fit_many(df, problems, fold_col="fold", label=LABEL)):
        assert all(np.allclose(getattr(a, k), getattr(b, k), rtol=0, atol=1e-9) for k in vars(a))
    other = C.fold_areas(df, C.GBT, points, n_folds=3)
    assert areas.keys() == other.keys() and len(areas) == 12
    assert all(areas[k] == pytest.approx(other[k], abs=1e-9) for k in areas)


def test_the_query_searches_the_whole_grid(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(queries, "_encoded", lambda *a: (None, None))
    monkeypatch.setattr(queries, "training_set", lambda *a: SimpleNamespace(rows=1))

    def fit(data, family, tuned, grid=None, **more):
        asked.extend(C.grid_points(grid))
        raise StopIteration

    monkeypatch.setattr(queries, "fit_family", fit)
    with pytest.raises(StopIteration):
        queries.gbt_tuned(spark, "")
    assert asked == C.grid_points(C.GBT_GRID) and len(asked) == 54
