"""Batch scoring: transactions in, risk of each customer out."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.scalars import class_probability
from riskframe.schema import CUSTOMER_ID, LABEL
from riskframe.sources.payloads import explode_payloads


def score_transactions(
    transactions: DataFrame,
    encoder: PipelineModel,
    classifier: PipelineModel,
    customer_id_col: str = CUSTOMER_ID,
) -> DataFrame:
    """(customer_id, risk_probability, is_high_risk), one row per customer.

    Only the given transactions count. If they carry a ``request_id``, each request
    is scored by itself and keeps its id.
    """
    scored = classifier.transform(encoder.transform(transactions))
    request = ["request_id"] if "request_id" in transactions.columns else []
    return scored.select(
        *request,
        F.col(customer_id_col).alias("customer_id"),
        class_probability("probability").alias("risk_probability"),
        F.col("prediction").cast("int").alias(LABEL),
    )


def score_payloads(
    requests: DataFrame, encoder: PipelineModel, classifier: PipelineModel
) -> DataFrame:
    """Score requests that arrive as JSON (columns ``request_id``, ``payload``)."""
    return score_transactions(explode_payloads(requests), encoder, classifier)
