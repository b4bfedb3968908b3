"""Projections of order and event tables onto the transaction schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.functions.columns import replace_columns
from riskframe.functions.sql import name
from riskframe.schema import TRANSACTION_SCHEMA

_KEYED = {
    "TransactionId": "{key}",
    "BatchId": "{key} % 100",
    "AccountId": "{customer}",
    "SubscriptionId": "{customer}",
    "CustomerId": "{customer}",
    "CurrencyCode": "'UGX'",
    "CountryCode": "256",
    "ProviderId": "'P' || {key} % 6",
    "ProductId": "'PR' || {key} % 23",
    "FraudResult": "if({key} % 500 = 0, 1, 0)",
}


def _project(df: DataFrame, key: str, customer: str, columns: dict[str, str]) -> DataFrame:
    """Each column of the schema from its expression, cast to its type, NaN as null."""
    made = {c: e.format(key=key, customer=customer) for c, e in {**_KEYED, **columns}.items()}
    cast = {f.name: f"cast({made[f.name]} as {f.dataType.simpleString()})" for f in TRANSACTION_SCHEMA}
    for f in TRANSACTION_SCHEMA:
        if f.dataType.typeName() == "double":
            cast[f.name] = f"nullif({cast[f.name]}, double('NaN'))"
    return df.selectExpr(*[f"{e} as {name(c)}" for c, e in cast.items()])


def tx_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(
        spark.read.parquet(f"{sf_dir}/orders.parquet"),
        "o_orderkey",
        "o_custkey",
        {
            "ProductCategory": "o_orderpriority",
            "ChannelId": "o_orderstatus",
            "Amount": "if(o_orderstatus = 'P', -o_totalprice, o_totalprice)",
            "Value": "o_totalprice",
            "TransactionStartTime": "o_orderdate",
            "PricingStrategy": "{key} % 5",
        },
    )


def tx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(
        spark.read.parquet(f"{sf_dir}/events.parquet"),
        "event_id",
        "user_id",
        {
            "ProductCategory": "event_type",
            "ChannelId": "'CH' || event_id % 4",
            "Amount": "if(event_type = 'error', -value, value)",
            "Value": "value",
            "TransactionStartTime": "ts",
            "PricingStrategy": "cast(get_json_object(props, '$.k') as int) % 5",
        },
    )


def tx_events_bad_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event transactions with times as text, every 97th of them unreadable."""
    bad = "cast(TransactionId as bigint) % 97 = 0"
    text = "cast(TransactionStartTime as string)"
    return replace_columns(
        tx_events(spark, sf_dir), {"TransactionStartTime": f"if({bad}, 'not-a-date', {text})"}
    )


def tx_orders_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order transactions whose amount is NaN in every 41st row."""
    bad = "cast(TransactionId as bigint) % 41 = 0"
    return replace_columns(tx_orders(spark, sf_dir), {"Amount": f"if({bad}, double('NaN'), Amount)"})


def tx_events_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event transactions with times as text, day first, to the second."""
    text = "date_format(TransactionStartTime, 'dd/MM/yyyy HH:mm:ss')"
    return replace_columns(tx_events(spark, sf_dir), {"TransactionStartTime": text})


def tx_orders_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order transactions with gaps in amount, category and customer."""
    key = "cast(TransactionId as bigint)"
    return replace_columns(
        tx_orders(spark, sf_dir),
        {
            "Amount": f"if({key} % 41 != 0, Amount, null)",
            "ProductCategory": f"if({key} % 53 != 0, ProductCategory, null)",
            "CustomerId": f"if({key} % 211 != 0, CustomerId, null)",
        },
    )
