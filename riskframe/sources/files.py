"""CSV sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions import sql
from riskframe.functions.columns import nans_to_nulls, require_columns
from riskframe.schema import CUSTOMER_ID, LABEL, START_TIME, TRANSACTION_SCHEMA


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).csv(path).columns


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV by a schema whose names every file's header must give in the same order."""
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return reader.csv(path)


# Kinds of text, one bit each, so that the kinds of a column merge by "or" in any order.
WHOLE, REAL, TIME, TEXT = 1, 2, 4, 8
WHOLE_PATTERN = "^[+-]?(0|[1-9][0-9]{0,17})$"
REAL_PATTERN = "^[+-]?((0|[1-9][0-9]*)([.][0-9]*([eE][+-]?[0-9]{1,3})?|[eE][+-]?[0-9]{1,3})|[.][0-9]+([eE][+-]?[0-9]{1,3})?)$"
TIME_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$"


def kind_of(column: str) -> str:
    """SQL: the kind of a text cell; 0 where it says nothing (null, empty, NaN)."""
    c = sql.name(column)
    return f"""case when {c} is null or {c} = '' or lower({c}) = 'nan' then 0
        when {c} rlike '{WHOLE_PATTERN}' then {WHOLE} when {c} rlike '{REAL_PATTERN}' then {REAL}
        when {c} rlike '{TIME_PATTERN}' and try_cast({c} as timestamp) is not null then {TIME} else {TEXT} end"""


def merged_type(kinds: int | None) -> str:
    """The narrowest type for all kinds met: whole numbers widen to double, all else to text."""
    return {WHOLE: "bigint", REAL: "double", WHOLE | REAL: "double", TIME: "timestamp"}.get(kinds, "string")


def column_types(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The type of each text column, from all its rows; the driver gets one number a column.

    Numbers with leading zeros, of more than 18 digits or with blanks around them stay text,
    and so does a column without any value.
    """
    if not columns:
        return {}
    merged = [f"bit_or({kind_of(c)}) as k{i}" for i, c in enumerate(columns)]
    row = df.selectExpr(*merged).first()
    return {c: merged_type(row[i]) for i, c in enumerate(columns)}


def with_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns as the given types; a cell that says nothing becomes null, in text it stays."""
    cast = {c: t for c, t in types.items() if t != "string"}
    return df.selectExpr(
        *[f"try_cast({sql.name(c)} as {cast[c]}) as {sql.name(c)}" if c in cast else sql.name(c) for c in df.columns]
    )


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Any CSV with a header row, each column of the narrowest type that holds all its rows.

    One pass over all files finds the types, so files that disagree are widened: whole
    numbers beside fractions give double, numbers beside words give text. Headers must agree.
    """
    header = _header(spark, path)
    raw = _read(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in header]))
    return nans_to_nulls(with_types(raw, column_types(raw, header)))


def read_transactions_csv(spark: SparkSession, path: str, infer: bool = True) -> DataFrame:
    """Transactions from CSV with a header row.

    Columns are matched by name, in whatever order the file has them; all files of a
    folder must have the header of the first, else the read fails. The start time stays
    text, since each consumer parses it leniently or strictly. Columns beyond those of a
    transaction get the type ``read_csv`` would give them, by a pass over these columns, or
    stay text without ``infer``. A missing path raises ``AnalysisException``.
    """
    types = {f.name: f.dataType for f in TRANSACTION_SCHEMA}
    types[START_TIME] = T.StringType()
    # The capped table widens integer columns to double, so integers may read "2.0".
    types["PricingStrategy"] = T.DoubleType()
    header = _header(spark, path)
    schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
    raw = _read(spark, path, schema)
    others = [c for c in header if c not in types] if infer else []
    return nans_to_nulls(with_types(raw, column_types(raw, others)) if others else raw)


def read_keyed_csv(spark: SparkSession, path: str, key: str = CUSTOMER_ID) -> DataFrame:
    """A feature or label table: the key as text, the label as int, the rest double."""
    header = _header(spark, path)
    if key not in header:
        raise ValueError(f"key column {key!r} not found in {header}")
    types = {key: T.StringType(), LABEL: T.IntegerType()}
    schema = T.StructType([T.StructField(c, types.get(c, T.DoubleType())) for c in header])
    return nans_to_nulls(_read(spark, path, schema))


def write_csv(df: DataFrame, path: str, key: str | None = None, mode: str = "overwrite") -> None:
    """CSV with a header row; with ``key`` that column comes first."""
    if key is not None:
        require_columns(df, key)
        df = df.select(key, *[c for c in df.columns if c != key])
    df.write.mode(mode).option("header", True).csv(path)
