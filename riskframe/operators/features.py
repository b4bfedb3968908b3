"""Transactions to one row per customer: features, target, RFM.

Every aggregate except the distinct count of categories combines map-side, so a
customer that holds a large share of all rows costs no more to merge than any
other. The distinct count makes Spark group by (customer, category) first, which
again combines map-side. Nothing collects the rows of a customer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions import scalars as S
from riskframe.functions import sql
from riskframe.functions.columns import require_columns
from riskframe.schema import (
    AMOUNT,
    CUSTOMER_ID,
    FEATURES,
    LAST_TIME_FEATURES,
    START_TIME,
    TIME_PARTS,
)
from riskframe.session import stage

_ON_BAD = ("null", "raise")


def with_timestamp(
    df: DataFrame,
    timestamp_col: str = START_TIME,
    on_bad_timestamp: str = "null",
    formats: Sequence[str] = (),
) -> DataFrame:
    """The time column as timestamp; text that is no date gives null, or fails the job."""
    require_columns(df, timestamp_col)
    if on_bad_timestamp not in _ON_BAD:
        raise ValueError(f"on_bad_timestamp must be one of {_ON_BAD}")
    if dict(df.dtypes)[timestamp_col] == "timestamp_ntz":
        return df
    if on_bad_timestamp == "raise":
        parsed = S.strict_timestamp(timestamp_col, formats)
    else:
        parsed = S.lenient_timestamp(timestamp_col, formats)
    return df.withColumn(timestamp_col, parsed)


def drop_undated(df: DataFrame, timestamp_col: str = START_TIME) -> DataFrame:
    """Rows with a time."""
    return df.filter(F.col(timestamp_col).isNotNull())


def undated_rows(
    df: DataFrame, timestamp_col: str = START_TIME, formats: Sequence[str] = ()
) -> DataFrame:
    """One row: how many rows there are, and how many ``drop_undated`` leaves out."""
    read = with_timestamp(df, timestamp_col, formats=formats)
    return read.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(timestamp_col).isNull()).alias("n_dropped"),
    )


def _feature_aggregates(
    timestamp_col: str, exact_distinct: bool, only_dated: bool = False
) -> list[Column]:
    """The feature columns but for the time parts, over all rows or over the dated ones."""

    def rows(column: str) -> str:
        return f"if({sql.name(timestamp_col)} is null, null, {column})" if only_dated else column

    category = rows("ProductCategory")
    distinct = f"count(distinct {category})"
    if not exact_distinct:
        distinct = f"approx_count_distinct({category})"
    made = {
        "total_transaction_amount": f"coalesce(sum({rows(AMOUNT)}), 0D)",
        "average_transaction_amount": f"avg({rows(AMOUNT)})",
        "std_transaction_amount": f"coalesce(stddev_samp({rows(AMOUNT)}), 0D)",
        "transaction_count": f"count({rows('TransactionId')})",
        "average_pricing_strategy": f"avg({rows('PricingStrategy')})",
        "distinct_product_categories": distinct,
        "_last": f"max({sql.name(timestamp_col)})",
    }
    return [F.expr(e).alias(c) for c, e in made.items()]


# Spark's name of each part of a time.
_PART = {"hour": "hour", "day": "dayofmonth", "month": "month", "year": "year"}


def _feature_columns() -> list[str]:
    """The features in order, the time parts taken from the latest time."""
    parts = {
        name: f"cast(coalesce({_PART[part]}(_last), 0) as bigint) as {name}"
        for name, part in zip(LAST_TIME_FEATURES, TIME_PARTS)
    }
    return [parts.get(c, c) for c in FEATURES]


def customer_features(
    df: DataFrame,
    customer_id_col: str = CUSTOMER_ID,
    timestamp_col: str = START_TIME,
    target_col: str | None = None,
    keys: Sequence[str] = (),
    exact_distinct: bool = True,
    on_bad_timestamp: str = "null",
    formats: Sequence[str] = (),
) -> DataFrame:
    """One feature row per customer, from the rows that have a readable time.

    With ``target_col`` the customer's greatest target is added from the same
    aggregation. ``keys`` are grouped on beside the customer (a request id, say).
    Rows without a customer are left out. ``formats`` are date patterns tried after ISO.
    """
    require_columns(df, customer_id_col, timestamp_col)
    dated = drop_undated(
        with_timestamp(df, timestamp_col, on_bad_timestamp, formats), timestamp_col
    )
    aggregates = _feature_aggregates(timestamp_col, exact_distinct)
    if target_col is not None:
        aggregates.append(F.max(target_col).alias("Target"))
    group = [*keys, customer_id_col]
    grouped = (
        dated.filter(F.col(customer_id_col).isNotNull()).groupBy(*group).agg(*aggregates)
    )
    target = ["Target"] if target_col is not None else []
    return grouped.selectExpr(*map(sql.name, group), *_feature_columns(), *target)


def customer_target_max(
    df: DataFrame, target_col: str, customer_id_col: str = CUSTOMER_ID, timestamp_col: str = START_TIME
) -> DataFrame:
    """The greatest target of each customer, over the rows that have a readable time."""
    dated = drop_undated(with_timestamp(df, timestamp_col), timestamp_col)
    return (
        dated.filter(F.col(customer_id_col).isNotNull())
        .groupBy(customer_id_col)
        .agg(F.max(target_col).alias("Target"))
    )


def _with_recency(summary: DataFrame, latest: DataFrame, *columns: str) -> DataFrame:
    """Adds recency against the day after the latest time of all; ``latest`` is one row."""
    recency = "timestampdiff(DAY, _last, _latest + INTERVAL 1 DAY) as Recency"
    return summary.crossJoin(F.broadcast(latest)).selectExpr(
        *columns, recency, "Frequency", "Monetary"
    )


def rfm(
    df: DataFrame,
    customer_id_col: str = CUSTOMER_ID,
    timestamp_col: str = START_TIME,
    amount_col: str = AMOUNT,
    on_bad_timestamp: str = "raise",
    formats: Sequence[str] = (),
) -> DataFrame:
    """Recency (days), frequency (rows) and monetary (sum) of each customer.

    The snapshot is the day after the latest time in the whole table, rows without
    a customer included. The grouping is stored, so the transactions are scanned once.
    """
    require_columns(df, customer_id_col, timestamp_col, amount_col)
    dated = with_timestamp(df, timestamp_col, on_bad_timestamp, formats)
    # Rows without a customer form one more group, only for the latest time.
    summary = stage(
        dated.groupBy(customer_id_col).agg(
            F.max(timestamp_col).alias("_last"),
            F.count(F.lit(1)).alias("Frequency"),
            F.coalesce(F.sum(amount_col), F.lit(0.0)).alias("Monetary"),
        ),
        "rfm",
    )
    latest = summary.agg(F.max("_last").alias("_latest"))
    known = summary.filter(F.col(customer_id_col).isNotNull())
    return _with_recency(known, latest, sql.name(customer_id_col))


def features_and_rfm(
    df: DataFrame,
    customer_id_col: str = CUSTOMER_ID,
    timestamp_col: str = START_TIME,
    exact_distinct: bool = True,
    on_bad_timestamp: str = "raise",
    formats: Sequence[str] = (),
) -> DataFrame:
    """Features and RFM of each customer from one pass over the transactions.

    The grouping is stored and the latest time of all read from it, so the
    transactions are scanned once. Features count the rows that have a time, RFM
    counts all rows, as the separate functions do. A customer without any dated row
    is left out.
    """
    require_columns(df, customer_id_col, timestamp_col)
    dated = with_timestamp(df, timestamp_col, on_bad_timestamp, formats)
    customer = sql.name(customer_id_col)
    # Rows without a customer form one more group, only for the latest time.
    summary = stage(
        dated.groupBy(customer_id_col).agg(
            *_feature_aggregates(timestamp_col, exact_distinct, only_dated=True),
            F.count(F.lit(1)).alias("Frequency"),
            F.expr(f"coalesce(sum({AMOUNT}), 0D) as Monetary"),
        ),
        "customers",
    )
    latest = summary.selectExpr("cast(max(_last) as string)").first()[0]
    snapshot = f"cast({sql.literal(latest)} as timestamp_ntz) + INTERVAL 1 DAY"
    return summary.filter(f"{customer} is not null and _last is not null").selectExpr(
        customer,
        *_feature_columns(),
        f"timestampdiff(DAY, _last, {snapshot}) as Recency",
        "Frequency",
        "Monetary",
    )


def first_per_customer(
    df: DataFrame, customer_id_col: str = CUSTOMER_ID, timestamp_col: str = START_TIME
) -> DataFrame:
    """The earliest non-missing value of each column per customer; equal times go by TransactionId."""
    order = f"struct({sql.name(timestamp_col)}, TransactionId)"
    rest = [sql.name(c) for c in df.columns if c != customer_id_col]
    aggregates = [F.expr(f"min_by({c}, if({c} is null, null, {order})) as {c}") for c in rest]
    return (
        df.filter(F.col(customer_id_col).isNotNull())
        .groupBy(customer_id_col)
        .agg(*aggregates)
        .select(*df.columns)
    )
