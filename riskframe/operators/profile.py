"""Profiling of a table: one pass for all columns wherever the result allows it."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import sql
from riskframe.functions.columns import doubles, melt, numeric_columns, string_columns
from riskframe.functions.scalars import percent
from riskframe.operators.quantiles import quantiles
from riskframe.operators.winsorize import REACH
from riskframe.schema import FRAUD


def per_column(
    df: DataFrame,
    columns: Sequence[str],
    stats: Mapping[str, Callable[[str], str]],
    known: Mapping[str, Callable[[str], str]] | None = None,
) -> DataFrame:
    """Aggregate every column in one pass, then turn the single row into one row per column.

    ``stats`` maps a name to a function from a column's SQL name to an aggregate,
    ``known`` to a function from the column to SQL that needs no rows.
    """
    names = list(stats)
    row = df.selectExpr(
        *[f"{stats[s](sql.name(c))} as c{i}_{s}" for i, c in enumerate(columns) for s in names]
    )
    structs = [
        "named_struct("
        + ", ".join(
            [
                f"'position', {i}L, 'column', {sql.text(c)}",
                *[f"'{s}', c{i}_{s}" for s in names],
                *[f"'{s}', {f(c)}" for s, f in (known or {}).items()],
            ]
        )
        + ")"
        for i, c in enumerate(columns)
    ]
    return row.selectExpr(f"inline(array({', '.join(structs)}))")


def _real(column: str) -> str:
    return f"cast({column} as double)"


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )


def column_info(df: DataFrame) -> DataFrame:
    """Position, type and number of non-missing values of each column."""
    types = dict(df.dtypes)
    return per_column(
        df,
        df.columns,
        {"non_null": lambda c: f"count({c})"},
        {"dtype": lambda c: sql.text(types[c])},
    )


def first_rows(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows in the order of a key; rows of a DataFrame have no order of their own."""
    return df.orderBy(*order_by).limit(n)


def describe_numeric(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True
) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of each numeric column."""
    columns = list(columns or numeric_columns(df))
    df = doubles(df, columns)
    quartiles = quantiles(df, columns, [0.25, 0.5, 0.75], exact)

    def quartile(i: int):
        return lambda c: sql.number(quartiles[c][i])

    return per_column(
        df,
        columns,
        {
            "count": lambda c: f"count({c})",
            "mean": lambda c: f"avg({_real(c)})",
            "std": lambda c: f"stddev_samp({c})",
            "min": lambda c: f"min({_real(c)})",
            "max": lambda c: f"max({_real(c)})",
        },
        {"q25": quartile(0), "q50": quartile(1), "q75": quartile(2)},
    ).select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def value_counts(df: DataFrame, columns: Sequence[str] | None = None, sort: bool = True) -> DataFrame:
    """How often each value occurs, for all string columns in one grouping."""
    columns = list(columns or string_columns(df))
    counted = (
        melt(df, columns, name="column", as_type="string")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.orderBy("column", F.desc("n"), "value") if sort else counted


def describe_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency; ties by least value."""
    columns = list(columns or string_columns(df))
    found = (
        value_counts(df, columns, sort=False)
        .groupBy("column")
        .agg(
            F.sum("n").alias("count"),
            F.count(F.lit(1)).alias("unique"),
            F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
            F.max("n").alias("freq"),
        )
    )
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return every.join(found, "column", "left").select(
        "column",
        F.coalesce("count", F.lit(0)).alias("count"),
        F.coalesce("unique", F.lit(0)).alias("unique"),
        "top",
        "freq",
    )


def missing_report(df: DataFrame) -> DataFrame:
    """Missing values per column, most first; no rows when nothing is missing."""
    counted = per_column(
        df,
        df.columns,
        {
            "missing_count": lambda c: f"count_if({c} is null)",
            "_rows": lambda c: "count(1)",
        },
    )
    return (
        counted.filter(F.col("missing_count") > 0)
        .select(
            "column", "missing_count", percent("missing_count", "_rows").alias("missing_percent")
        )
        .orderBy(F.desc("missing_percent"), "column")
    )


def missing_pattern(df: DataFrame) -> DataFrame:
    """Which columns are missing together: a 0/1 text in column order, and its rows."""
    bits = [f"if({sql.name(c)} is null, '1', '0')" for c in df.columns]
    return (
        df.selectExpr(f"concat({', '.join(bits)}) as pattern")
        .groupBy("pattern")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def constant_columns(df: DataFrame) -> DataFrame:
    """Columns with a single value among the non-missing ones.

    Least and greatest value agree exactly when there is one value, so this needs no
    distinct count and no shuffle.
    """
    return (
        per_column(
            df,
            df.columns,
            {
                "value": lambda c: f"cast(min({c}) as string)",
                "_same": lambda c: f"min({c}) = max({c})",
            },
        )
        .filter("_same")
        .select("column", "value")
    )


def class_counts(df: DataFrame, label_col: str) -> DataFrame:
    return (
        df.filter(F.col(label_col).isNotNull())
        .groupBy(label_col)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def class_balance(df: DataFrame, label_col: str = FRAUD) -> DataFrame:
    """Rows and share in percent of each class.

    The total is a window over the classes, of which there are few, so the table is
    scanned once.
    """
    counted = class_counts(df, label_col).withColumn("_total", F.expr("sum(n) over ()"))
    return counted.select(
        F.col(label_col).alias("label"), "n", percent("n", "_total").alias("percent")
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of each ordered pair of numeric columns as (x, y, correlation).

    Every pair uses the rows where both are present; a constant column gives null.
    All pairs come out of one pass.
    """
    columns = list(columns or numeric_columns(df))
    df = doubles(df, columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]

    def correlation(a: str, b: str) -> str:
        both = f"{sql.name(a)} is not null and {sql.name(b)} is not null"
        x, y = f"if({both}, {sql.as_double(a)}, null)", f"if({both}, {sql.as_double(b)}, null)"
        return f"try_divide(covar_pop({x}, {y}), stddev_pop({x}) * stddev_pop({y}))"

    row = df.selectExpr(*[f"{correlation(a, b)} as r{i}" for i, (a, b) in enumerate(pairs)])
    cells = [
        f"struct({sql.text(x)} as x, {sql.text(y)} as y, r{i} as correlation)"
        for i, (a, b) in enumerate(pairs)
        for x, y in dict.fromkeys(((a, b), (b, a)))
    ]
    return row.selectExpr(f"inline(array({', '.join(cells)}))")


def redundant_pairs(
    df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 0.9
) -> DataFrame:
    """Pairs of different columns whose correlation reaches the threshold in size."""
    return correlation_matrix(df, columns).filter(
        (F.col("x") < F.col("y")) & (F.abs("correlation") >= threshold)
    )


def boxplot_stats(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    exclude: Iterable[str] = (FRAUD,),
    exact: bool = True,
) -> DataFrame:
    """Quartiles, whiskers (the furthest values inside the fences) and outliers."""
    columns = list(columns or numeric_columns(df, exclude))
    df = doubles(df, columns)
    medians = quantiles(df, columns, [0.25, 0.5, 0.75], exact)
    present = [c for c in columns if medians[c][0] is not None]
    low, high = {}, {}
    for c in present:
        q1, _, q3 = medians[c]
        low[sql.name(c)] = sql.number(q1 - REACH * (q3 - q1))
        high[sql.name(c)] = sql.number(q3 + REACH * (q3 - q1))

    def inside(c: str) -> str:
        return f"if({_real(c)} between {low[c]} and {high[c]}, {_real(c)}, null)"

    def known(i: int):
        return lambda c: sql.number(medians[c][i])

    return per_column(
        df,
        present,
        {
            "whisker_low": lambda c: f"min({inside(c)})",
            "whisker_high": lambda c: f"max({inside(c)})",
            "outliers": lambda c: f"count_if({_real(c)} < {low[c]} or {_real(c)} > {high[c]})",
        },
        {"q1": known(0), "median": known(1), "q3": known(2)},
    ).drop("position")
