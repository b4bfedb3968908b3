"""Quality of classifiers, for one model or for many in the same job.

Input is a long table: label (0/1), score, prediction (0/1) and the model's name.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import sql

SCORE_BUCKETS = 1_024
METRICS = ("accuracy", "precision", "recall", "f1")


def _score_bounds(df: DataFrame, score_col: str, buckets: int) -> list[float]:
    """Rough quantiles of the scores. They spread the work; no result depends on them."""
    probabilities = ", ".join(sql.number(i / buckets) for i in range(1, buckets))
    found = f"percentile_approx({sql.name(score_col)}, array({probabilities}), {10 * buckets})"
    bounds = df.selectExpr(found).first()[0] or []
    return sorted({b for b in bounds if math.isfinite(b)}) or [0.0]


def roc_auc(
    df: DataFrame,
    label_col: str = "label",
    score_col: str = "score",
    by: Sequence[str] = ("model",),
    buckets: int = SCORE_BUCKETS,
) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null if a class is absent.

    Equal scores are merged map-side first, so a score shared by many rows is one
    row. The order statistics then come in two levels: inside buckets of the score,
    and over the totals of the buckets, of which there are at most ``buckets``.
    """
    keys = [sql.name(k) for k in by]
    grouping = ", ".join(keys)
    label, score = sql.name(label_col), sql.as_double(score_col)
    known = df.filter(f"{label} is not null and {score} is not null").selectExpr(
        *keys, f"{label} as _label", f"{score} as _score"
    )
    splits = [float("-inf"), *_score_bounds(known, "_score", buckets), float("inf")]
    distinct = known.groupBy(*by, "_score").agg(
        F.expr("count_if(_label = 1) as pos"), F.expr("count_if(_label = 0) as neg")
    )
    bucketed = Bucketizer(
        splits=splits, inputCol="_score", outputCol="_bucket", handleInvalid="keep"
    ).transform(distinct)
    partition = ", ".join([*keys, "_bucket"])
    before = "rows between unbounded preceding and 1 preceding"
    totals = (
        bucketed.selectExpr(
            "*",
            f"coalesce(sum(pos) over (partition by {partition} order by _score desc {before}), 0)"
            " as above",
        )
        .groupBy(*by, "_bucket")
        .agg(
            F.expr("sum(neg * (above + pos * 0.5D)) as pairs"),
            F.expr("sum(pos) as pos"),
            F.expr("sum(neg) as neg"),
        )
    )
    over = f"(partition by {grouping} order by _bucket desc {before})" if keys else (
        f"(order by _bucket desc {before})"
    )
    return (
        totals.selectExpr("*", f"coalesce(sum(pos) over {over}, 0) as beyond")
        .groupBy(*by)
        .agg(
            F.expr(
                "try_divide(sum(pairs + neg * cast(beyond as double)), "
                "cast(sum(pos) as double) * sum(neg)) as roc_auc"
            )
        )
    )


def _or_zero(numerator: str, denominator: str) -> str:
    return f"coalesce(try_divide(cast({numerator} as double), {denominator}), 0D)"


_F1 = _or_zero("2 * precision * recall", "precision + recall")


def binary_metrics(
    df: DataFrame,
    label_col: str = "label",
    prediction_col: str = "prediction",
    by: Sequence[str] = ("model",),
) -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1; 0 where undefined."""
    label, predicted = sql.name(label_col), sql.name(prediction_col)
    cells = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
    counts = df.groupBy(*by).agg(
        *[
            F.expr(f"count_if({label} = {y} and {predicted} = {p}) as {cell}")
            for cell, (y, p) in cells.items()
        ]
    )
    return counts.selectExpr(
        "*",
        f"{_or_zero('tp + tn', 'tp + fp + fn + tn')} as accuracy",
        f"{_or_zero('tp', 'tp + fp')} as precision",
        f"{_or_zero('tp', 'tp + fn')} as recall",
    ).selectExpr(*map(sql.name, by), "accuracy", "precision", "recall", f"{_F1} as f1")


def classification_report(
    df: DataFrame,
    label_col: str = "label",
    prediction_col: str = "prediction",
    by: Sequence[str] = ("model",),
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and the two averages.

    The accuracy row carries the accuracy in all three measures.
    """
    keys = [sql.name(k) for k in by]
    label, predicted = sql.name(label_col), sql.name(prediction_col)
    measures = ("precision", "recall", "f1")
    cells = df.groupBy(*by, label_col, prediction_col).agg(F.count(F.lit(1)).alias("n"))
    # One row per cell of the confusion table and side, so few whatever the table.
    sides = cells.selectExpr(
        *keys,
        "n",
        f"{label} = {predicted} as right",
        f"inline(array(struct(cast({label} as bigint) as class, true as actual), "
        f"struct(cast({predicted} as bigint) as class, false as actual)))",
    )
    classes = (
        sides.groupBy(*by, "class")
        .agg(
            F.expr("coalesce(sum(if(actual and right, n, null)), 0L) as hits"),
            F.expr("coalesce(sum(if(actual, n, null)), 0L) as support"),
            F.expr("coalesce(sum(if(actual, null, n)), 0L) as predicted"),
        )
        .selectExpr(
            "*",
            f"{_or_zero('hits', 'predicted')} as precision",
            f"{_or_zero('hits', 'support')} as recall",
        )
        .selectExpr("*", f"{_F1} as f1")
    )
    per_class = classes.selectExpr(*keys, "cast(class as string) as row", *measures, "support")

    def summary_row(row: str, measure) -> str:
        made = ", ".join(f"{measure(m)} as {m}" for m in measures)
        return f"struct('{row}' as row, {made}, sum(support) as support)"

    rows = [
        summary_row("accuracy", lambda m: _or_zero("sum(hits)", "sum(support)")),
        summary_row("macro avg", lambda m: f"avg({m})"),
        summary_row("weighted avg", lambda m: _or_zero(f"sum({m} * support)", "sum(support)")),
    ]
    summary = classes.groupBy(*by).agg(F.expr(f"array({', '.join(rows)}) as rows"))
    return per_class.unionByName(summary.selectExpr(*keys, "inline(rows)"))


def model_comparison(
    df: DataFrame,
    label_col: str = "label",
    score_col: str = "score",
    prediction_col: str = "prediction",
    by: Sequence[str] = ("model",),
) -> DataFrame:
    """AUC and the binary metrics of every model in one table."""
    # One row per model on either side.
    return roc_auc(df, label_col, score_col, by).join(
        binary_metrics(df, label_col, prediction_col, by), list(by)
    )


def best_run(runs: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """The run with the greatest value of a metric in its ``metrics`` map; ties by name."""
    value = F.element_at("metrics", F.lit(metric))
    return (
        runs.filter(value.isNotNull())
        .orderBy(F.desc(value), "run_name")
        .limit(1)
    )
