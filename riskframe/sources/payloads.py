"""Scoring requests: JSON arrays of transactions."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.schema import CUSTOMER_ID, REQUEST_SCHEMA, START_TIME

_TEXT_TYPE = T.ArrayType(T.StructType([T.StructField(f.name, T.StringType()) for f in REQUEST_SCHEMA]))


def _parsed(requests: DataFrame, payload: str) -> DataFrame:
    """Requests with their transactions, each payload parsed once.

    Fields are read as text and cast, so a number may come in quotes. The parsed array
    goes through ``explode``, which keeps a later filter from parsing it again.
    """
    texts = F.from_json(payload, _TEXT_TYPE)
    typed = F.transform(
        texts,
        lambda t: F.struct(*[t[f.name].try_cast(f.dataType).alias(f.name) for f in REQUEST_SCHEMA]),
    )
    return requests.select("*", F.explode(F.array(typed)).alias("_transactions"))


def _complete() -> F.Column:
    """True where every field of every transaction is present and well typed.

    A field that cannot be read as its type or is left out is null. The time is only required
    to be present: whether it is a date is decided later, leniently.
    """
    return F.forall(
        "_transactions",
        lambda t: reduce(and_, [t[f.name].isNotNull() for f in REQUEST_SCHEMA]),
    )


def _usable() -> F.Column:
    some = F.col("_transactions").isNotNull() & (F.size("_transactions") > 0)
    return F.coalesce(some & _complete(), F.lit(False))


def explode_payloads(
    requests: DataFrame, request_id: str = "request_id", payload: str = "payload"
) -> DataFrame:
    """One row per transaction of each well-formed request."""
    return (
        _parsed(requests, payload)
        .filter(_usable())
        .select(request_id, F.inline("_transactions"))
    )


def rejected_payloads(
    requests: DataFrame, request_id: str = "request_id", payload: str = "payload"
) -> DataFrame:
    """Requests that cannot be read, each with the reason."""
    reason = (
        F.when(F.col("_transactions").isNull(), "malformed payload")
        .when(F.size("_transactions") == 0, "no transactions")
        .otherwise("bad or missing field")
    )
    return (
        _parsed(requests, payload)
        .filter(~_usable())
        .select(request_id, reason.alias("reason"))
    )


def to_payloads(transactions: DataFrame, per_request: int = 256, tasks: int | None = None) -> DataFrame:
    """Pack transactions into requests, for tests and demonstrations.

    A request holds transactions of one customer out of a run of ``per_request``
    transaction numbers, so no group grows beyond that however busy a customer is.
    ``tasks`` sets the partitions that requests are packed in, and by which what follows
    reads them: parsing costs far more than the bytes it reads, by which Spark would merge
    partitions into a few long tasks. None leaves that to Spark.
    """
    chunk = F.floor(F.col("TransactionId").cast("bigint") / per_request)
    body = transactions.withColumn(
        START_TIME, F.col(START_TIME).cast("string")
    ).select(
        F.concat_ws("-", F.col(CUSTOMER_ID), chunk.cast("string")).alias("request_id"),
        F.struct(*[F.col(f.name) for f in REQUEST_SCHEMA]).alias("_tx"),
    )
    if tasks is not None:
        body = body.repartition(tasks, "request_id")
    packed = F.to_json(F.array_sort(F.collect_list("_tx")))
    return body.groupBy("request_id").agg(packed.alias("payload"))
