"""Column names and types of the tables the library works on."""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMER_ID = "CustomerId"
START_TIME = "TransactionStartTime"
AMOUNT = "Amount"
FRAUD = "FraudResult"
LABEL = "is_high_risk"

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("TransactionId", T.StringType()),
        T.StructField("BatchId", T.StringType()),
        T.StructField("AccountId", T.StringType()),
        T.StructField("SubscriptionId", T.StringType()),
        T.StructField(CUSTOMER_ID, T.StringType()),
        T.StructField("CurrencyCode", T.StringType()),
        T.StructField("CountryCode", T.IntegerType()),
        T.StructField("ProviderId", T.StringType()),
        T.StructField("ProductId", T.StringType()),
        T.StructField("ProductCategory", T.StringType()),
        T.StructField("ChannelId", T.StringType()),
        T.StructField(AMOUNT, T.DoubleType()),
        T.StructField("Value", T.DoubleType()),
        T.StructField(START_TIME, T.TimestampNTZType()),
        T.StructField("PricingStrategy", T.IntegerType()),
        T.StructField(FRAUD, T.IntegerType()),
    ]
)

# A request carries no outcome, and its times arrive as text.
REQUEST_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name == START_TIME else f.dataType)
        for f in TRANSACTION_SCHEMA
        if f.name != FRAUD
    ]
)

TIME_PARTS = ("hour", "day", "month", "year")
LAST_TIME_FEATURES = tuple(f"last_transaction_{part}" for part in TIME_PARTS)

# Feature names, in the order the feature matrix uses.
FEATURES = (
    "total_transaction_amount",
    "average_transaction_amount",
    "std_transaction_amount",
    "transaction_count",
    "average_pricing_strategy",
    "distinct_product_categories",
    *LAST_TIME_FEATURES,
)

RFM = ("Recency", "Frequency", "Monetary")
