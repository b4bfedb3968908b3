"""Training, comparison and choice of classifiers."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.classifiers import (
    FAMILIES,
    WEIGHT,
    Family,
    assembler,
    fit_baseline,
    fit_tuned,
    predict,
)
from riskframe.operators.metrics import METRICS, best_run, classification_report, model_comparison
from riskframe.operators.split import (
    balanced_weights,
    class_sizes,
    stratified_folds,
    stratified_split,
    test_sizes,
)
from riskframe.plans.runs import log_run, read_runs, save_model
from riskframe.schema import CUSTOMER_ID, FEATURES, LABEL
from riskframe.session import stage

MODEL_NAME = "risk_classifier"


@dataclass(frozen=True)
class TrainingSet:
    train: DataFrame
    test: DataFrame
    rows: int
    n_folds: int


def training_set(
    labelled: DataFrame,
    columns: Sequence[str] = FEATURES,
    key_col: str = CUSTOMER_ID,
    test_size: float = 0.2,
    n_folds: int = 5,
    seed: int = 42,
) -> TrainingSet:
    """Split, folds, class weights and feature vectors.

    All of them are expressions over ``labelled``, a stored table with one row per key:
    two small jobs find the cuts of split and folds, and no rows move.
    """
    sizes = class_sizes(labelled, LABEL, key_col)
    held_out = test_sizes(sizes, test_size)
    kept = {c: n - held_out[c] for c, n in sizes.items() if n > held_out[c]}
    split = stratified_split(labelled, key_col, LABEL, test_size, seed, sizes)
    train = split.filter("is_test = 0")
    folded = stratified_folds(train, key_col, LABEL, n_folds, seed, kept)
    weighted = balanced_weights(folded, LABEL, WEIGHT, kept)
    to_vector = assembler(columns)
    return TrainingSet(
        to_vector.transform(weighted).select(key_col, LABEL, "features", "fold", WEIGHT),
        to_vector.transform(split.filter("is_test = 1")).select(key_col, LABEL, "features"),
        sum(kept.values()),
        n_folds,
    )


@dataclass(frozen=True)
class Fitted:
    name: str
    model: Model
    params: Mapping
    cv_roc_auc: float | None = None
    family: str = ""


def fit_family(
    data: TrainingSet,
    family: Family,
    tuned: bool,
    grid: Mapping | None = None,
    tasks: int | None = None,
    **search,
) -> Fitted:
    """Fit one family. ``tasks`` sets the partitions of the training rows, which are read
    many times; None leaves them as they are."""
    train = data.train if tasks is None else data.train.coalesce(tasks)
    train = train.persist()
    try:
        if not tuned:
            params = {**family.default, **(grid or {})}
            model = fit_baseline(train, family, params)
            return Fitted(f"{family.name}_baseline", model, params, None, family.name)
        found = fit_tuned(train, family, grid, data.n_folds, **search)
        return Fitted(
            f"{family.name}_tuned", found.model, found.params, found.cv_roc_auc, family.name
        )
    finally:
        train.unpersist()


def scored(models: Sequence[Fitted], test: DataFrame) -> DataFrame:
    """The test rows scored by every model, as one long table."""
    return reduce(DataFrame.unionByName, [predict(m.model, test, m.name) for m in models])


@dataclass(frozen=True)
class Training:
    models: dict[str, Fitted]
    comparison: DataFrame
    report: DataFrame
    best: str
    version: int | None


def train_all(
    labelled: DataFrame,
    root: str,
    families: Sequence[Family] = FAMILIES,
    grids: Mapping[str, Mapping] | None = None,
    n_folds: int = 5,
    seed: int = 42,
    model_name: str = MODEL_NAME,
    tags: Mapping[str, str] | None = None,
) -> Training:
    """Fit every family as baseline and tuned, log the runs, store the best by test AUC."""
    spark = labelled.sparkSession
    data = training_set(stage(labelled, "labelled"), n_folds=n_folds, seed=seed)
    models = {}
    for family in families:
        for tuned in (False, True):
            grid = (grids or {}).get(family.name) if tuned else None
            fitted = fit_family(data, family, tuned, grid)
            models[fitted.name] = fitted
    scores = stage(scored(list(models.values()), data.test), "scores")
    comparison = model_comparison(scores)
    # One row per model.
    ids = []
    families_by_name = {f.name: f for f in families}
    for row in comparison.collect():
        fitted = models[row["model"]]
        # a run keeps its own artifact
        path = f"{root}/artifacts/{fitted.name}/{uuid.uuid4().hex}"
        PipelineModel([assembler(), fitted.model]).write().save(path)
        values = {m: row[m] for m in ("roc_auc", *METRICS)}
        if fitted.cv_roc_auc is not None:
            values["cv_roc_auc"] = fitted.cv_roc_auc
        weighted = "balanced" if families_by_name[fitted.family].weighted else "none"
        settings = {**fitted.params, "model_type": fitted.family, "class_weight": weighted}
        ids.append(log_run(spark, root, fitted.name, settings, values, path))
    these = read_runs(spark, root).filter(F.col("run_id").isin(ids))
    best = best_run(these).first()["run_name"]
    chosen = PipelineModel([assembler(), models[best].model])
    version = save_model(spark, chosen, root, model_name, tags)
    return Training(models, comparison, classification_report(scores), best, version)
