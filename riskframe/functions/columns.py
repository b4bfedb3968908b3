"""Choosing columns by type and name; reshaping columns to rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskframe.functions import sql
from riskframe.functions.scalars import nan_to_null


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in skip
    ]


def require_columns(df: DataFrame, *names: str) -> None:
    """Raise before any job starts if a column is absent."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}; the table has {df.columns}")


def nans_to_nulls(df: DataFrame) -> DataFrame:
    """One missing marker: NaN in a float column becomes null."""
    floats = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return df.withColumns({c: nan_to_null(c) for c in floats}) if floats else df


def replace_columns(df: DataFrame, changed: Mapping[str, str]) -> DataFrame:
    """Each column in its place, those in ``changed`` from their SQL; new ones at the end."""
    kept = [f"{changed[c]} as {sql.name(c)}" if c in changed else sql.name(c) for c in df.columns]
    new = [f"{e} as {sql.name(c)}" for c, e in changed.items() if c not in df.columns]
    return df.selectExpr(*kept, *new)


def doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the given columns, as double, NaN as null."""
    return df.selectExpr(*[f"{sql.as_double(c)} as {sql.name(c)}" for c in columns])


def melt(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = (),
    name: str = "feature",
    value: str = "value",
    as_type: str = "double",
) -> DataFrame:
    """One row per (row, column), all values cast to one type."""
    typed = df.selectExpr(
        *[sql.name(k) for k in keys],
        *[
            f"{sql.as_double(c) if as_type == 'double' else f'cast({sql.name(c)} as {as_type})'} as {sql.name(c)}"
            for c in columns
        ],
    )
    return typed.unpivot(list(keys), list(columns), name, value)


def round_doubles(df: DataFrame, digits: int, nudge: float = 1e-9) -> DataFrame:
    """Doubles rounded, with no negative zero.

    Means of cents often end in an exact half of the last digit; a tiny shift sends those
    the same way whatever order they were summed in.
    """
    doubles = [c for c, t in df.dtypes if t == "double"]
    return replace_columns(df, {c: f"round({sql.name(c)} + {nudge}D, {digits}) + 0D" for c in doubles})
