"""Logistic regression whose constant is penalized like any other coefficient.

With rows (x, t) of weight w and a constant 1 beside the features, the fit minimizes

    sum(w * log loss) * C + penalty,   penalty = sum(b * b) / 2 or sum(|b|)

over all coefficients b. Every Newton step is one pass over the rows: each task sums loss,
slope and curvature in numpy, Spark adds them up, and the driver solves for the step (for
the absolute penalty by coordinate descent on the quadratic model). A pass serves any number
of problems at once, those of a grid search on all folds included; a problem is done when
its step is below ``TOLERANCE``. The minimum is unique where it is squared, so the result
depends neither on partitions nor on a start.

Rows without a label, a weight or features count nowhere; without any row all coefficients
are zero.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions import sql

TOLERANCE = 1e-10
MOST_STEPS = 200


@dataclass(frozen=True)
class Problem:
    """One fit: its C, its penalty (l1 or l2), and the fold it leaves out."""

    C: float
    penalty: str
    without_fold: int | None = None


def moments(x: np.ndarray, t: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Loss, slope and upper curvature of the weighted log loss at b, in one array."""
    m = x @ b
    p = 1 / (1 + np.exp(-np.clip(m, -700, 700)))
    loss = float(w @ (np.logaddexp(0, m) - t * m))
    curvature = (x * (w * p * (1 - p))[:, None]).T @ x
    return np.concatenate(([loss], x.T @ (w * (p - t)), curvature[np.triu_indices(len(b))]))


def _sums(rows: DataFrame, asked: Sequence[tuple[int | None, np.ndarray]]) -> np.ndarray:
    """Moments for each (left out fold, coefficients), in one job."""
    width = len(asked[0][1])
    size = 1 + width + width * (width + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(asked), size))
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                x = np.column_stack((x, np.ones(len(x))))
                t, w, fold = (batch.column(i).to_numpy() for i in (1, 2, 3))
                for i, (without, b) in enumerate(asked):
                    held = slice(None) if without is None else fold != without
                    total[i] += moments(x[held], t[held], w[held], b)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["sums"])

    found = rows.mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("at", "value"))
    out = np.zeros(len(asked) * size)
    for at, value in found.groupBy("at").agg(F.sum("value")).collect():
        out[at] = value
    return out.reshape(len(asked), size)


def _soft(value: float, least: float) -> float:
    return np.sign(value) * max(abs(value) - least, 0.0)


def _step(problem: Problem, b: np.ndarray, slope: np.ndarray, curvature: np.ndarray) -> np.ndarray:
    """Where the quadratic model at b has its least penalized value, as a step from b."""
    if problem.penalty == "l2":
        return -np.linalg.solve(curvature + np.eye(len(b)), slope + b)
    d = np.zeros(len(b))
    scale = np.diag(curvature)
    for sweep in range(10_000):
        moved = 0.0
        for j in range(len(b)):
            pull = slope[j] + curvature[j] @ d - scale[j] * (b[j] + d[j])
            new = _soft(-pull, 1.0) / scale[j] - b[j] if scale[j] > 0 else -b[j]
            moved, d[j] = max(moved, abs(new - d[j])), new
        if moved < TOLERANCE / 100:
            break
        if sweep % 10 == 9 and (exact := _polished(b, d, slope, curvature)) is not None:
            return exact
    return d


def _polished(b: np.ndarray, d: np.ndarray, slope: np.ndarray, curvature: np.ndarray) -> np.ndarray | None:
    """The least point among those with the signs of b + d, or None if it is not the least of all.

    Sweeps find the signs early and then approach slowly where columns are correlated.
    """
    sign = np.sign(b + d)
    held = np.flatnonzero(sign)
    out = -b
    rest = slope + curvature @ np.where(sign == 0, out, 0.0)
    try:
        out[held] = np.linalg.solve(curvature[np.ix_(held, held)], -(rest + sign)[held])
    except np.linalg.LinAlgError:
        return None
    pull = slope + curvature @ out
    kept = (np.sign(b + out)[held] == sign[held]).all() and np.abs((pull + sign)[held]).max(initial=0) < 1e-6
    return out if kept and np.abs(pull[sign == 0]).max(initial=0) <= 1 + 1e-9 else None


def _penalty(problem: Problem, b: np.ndarray) -> float:
    return float(b @ b) / 2 if problem.penalty == "l2" else float(np.abs(b).sum())


def fit_many(
    train: DataFrame, problems: Sequence[Problem], features: str, label: str, weight: str | None, fold: str | None = None
) -> list[np.ndarray]:
    """Coefficients of every problem, the constant's last."""
    w = F.lit(1.0) if weight is None else F.col(sql.name(weight)).cast("double")
    of = F.lit(-1) if fold is None else F.coalesce(F.col(sql.name(fold)).cast("int"), F.lit(-1))
    rows = (
        train.select(
            vector_to_array(sql.name(features)).alias("x"), F.col(sql.name(label)).cast("double").alias("t"), w.alias("w"), of.alias("fold")
        )
        .filter("x is not null and t is not null and w is not null")
        .persist()
    )
    try:
        first = rows.select(F.size("x")).first()
        width = 1 + (first[0] if first else 0)
        if first is None:
            return [np.zeros(width) for _ in problems]
        return _solve(rows, problems, width)
    finally:
        rows.unpersist()


def _solve(rows: DataFrame, problems: Sequence[Problem], width: int) -> list[np.ndarray]:
    upper = np.triu_indices(width)
    best = [np.zeros(width) for _ in problems]
    value = [np.inf] * len(problems)
    step: list[np.ndarray | None] = [None] * len(problems)
    size, due = [1.0] * len(problems), [0.0] * len(problems)
    live = list(range(len(problems)))
    for _ in range(MOST_STEPS):
        tried = {i: best[i] if step[i] is None else best[i] + size[i] * step[i] for i in live}
        found = _sums(rows, [(problems[i].without_fold, tried[i]) for i in live])
        going = []
        for i, sums in zip(live, found):
            problem, b = problems[i], tried[i]
            now = problem.C * sums[0] + _penalty(problem, b)
            # at the end of the search differences are below the digits of the sums
            if now > value[i] + 1e-4 * size[i] * due[i] + 1e-11 * abs(now):
                size[i] /= 2
                if size[i] * np.abs(step[i]).max() >= TOLERANCE:
                    going.append(i)
                continue
            slope, curvature = problem.C * sums[1 : width + 1], np.zeros((width, width))
            curvature[upper] = problem.C * sums[width + 1 :]
            curvature = curvature + np.triu(curvature, 1).T
            best[i], value[i], size[i] = b, now, 1.0
            step[i] = _step(problem, b, slope, curvature)
            due[i] = float(slope @ step[i]) + _penalty(problem, b + step[i]) - _penalty(problem, b)
            if problem.penalty == "l2":
                due[i] = float((slope + b) @ step[i])
            if np.abs(step[i]).max() < TOLERANCE:
                best[i] = b + step[i]
            else:
                going.append(i)
        live = going
        if not live:
            return best
    raise RuntimeError(f"the fit did not settle in {MOST_STEPS} steps")


def margin(features: str, coefficients: Sequence[float]) -> Column:
    """The linear score of a vector column; the constant's coefficient is the last."""
    weights = F.array(*[F.lit(float(c)) for c in coefficients[:-1]]) if len(coefficients) > 1 else F.array().cast("array<double>")
    products = F.zip_with(vector_to_array(sql.name(features)), weights, lambda x, c: x * c)
    return F.aggregate(products, F.lit(float(coefficients[-1])), lambda total, x: total + x)


def logistic(value: Column) -> Column:
    return 1 / (1 + F.exp(-value))


class _Columns(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vectors", TypeConverters.toString)


class PenalizedLogisticModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Adds rawPrediction, probability and prediction by expressions; nulls stay null."""

    coefficients = Param(Params._dummy(), "coefficients", "the constant's is the last", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        value = margin(self.getOrDefault(self.featuresCol), self.getOrDefault(self.coefficients))
        m, p = F.col("_margin"), logistic(F.col("_margin"))
        return df.withColumn("_margin", value).select(
            *[F.col(sql.name(c)) for c in df.columns],
            array_to_vector(F.array(-m, m)).alias("rawPrediction"),
            array_to_vector(F.array(1 - p, p)).alias("probability"),
            (p > 0.5).cast("double").alias("prediction"),
        )


class PenalizedLogistic(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    labelCol = Param(Params._dummy(), "labelCol", "0 or 1", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "weight of a row", TypeConverters.toString)
    C = Param(Params._dummy(), "C", "weight of the loss", TypeConverters.toFloat)
    penalty = Param(Params._dummy(), "penalty", "l1 or l2", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", weightCol=None, C=1.0, penalty="l2"):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", C=1.0, penalty="l2")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> PenalizedLogisticModel:
        problem = Problem(self.getOrDefault(self.C), self.getOrDefault(self.penalty))
        weight = self.getOrDefault(self.weightCol) if self.isDefined(self.weightCol) else None
        (found,) = fit_many(df, [problem], self.getOrDefault(self.featuresCol), self.getOrDefault(self.labelCol), weight)
        model = PenalizedLogisticModel()
        return model._set(featuresCol=self.getOrDefault(self.featuresCol), coefficients=found.tolist())
