"""Bin edges and the assignment of values to bins.

A bin is closed on the right, and the lowest edge belongs to bin 1. Edges are a
handful of numbers, so assignment is a chain of comparisons in the projection, not
a range join. (``Bucketizer`` closes its bins on the left.)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from riskframe.functions import sql
from riskframe.functions.columns import replace_columns
from riskframe.operators.quantiles import quantiles

WIDEN = 0.001


def quantile_edges(
    df: DataFrame, columns: Sequence[str], bins: int = 10, exact: bool = True
) -> dict[str, list[float]]:
    """Edges at equal shares of the rows; equal edges are kept once."""
    probabilities = [i / bins for i in range(bins + 1)]
    fitted = quantiles(df, columns, probabilities, exact)
    return {
        c: list(dict.fromkeys(q for q in qs if q is not None)) for c, qs in fitted.items()
    }


def _uniform(low: float, high: float, bins: int) -> list[float]:
    constant = low == high
    if constant:
        pad = WIDEN * abs(low) if low != 0 else WIDEN
        low, high = low - pad, high + pad
    width = (high - low) / bins
    edges = [low + i * width for i in range(bins)] + [high]
    if not constant:
        edges[0] -= WIDEN * (high - low)
    return edges


def uniform_edges(df: DataFrame, columns: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Edges at equal distances, the lowest moved down a little so the minimum is inside."""
    row = df.selectExpr(
        *[
            f"struct(min({v}) as lo, max({v}) as hi) as {sql.name(c)}"
            for c, v in ((c, sql.as_double(c)) for c in columns)
        ]
    ).first()
    return {
        c: _uniform(row[c]["lo"], row[c]["hi"], bins) if row[c]["lo"] is not None else []
        for c in columns
    }


def fit_edges(
    df: DataFrame,
    columns: Sequence[str],
    bins: int = 10,
    strategy: str = "quantile",
    exact: bool = True,
) -> dict[str, list[float]]:
    if strategy == "quantile":
        return quantile_edges(df, columns, bins, exact)
    if strategy == "uniform":
        return uniform_edges(df, columns, bins)
    raise ValueError(f"strategy must be 'quantile' or 'uniform', not {strategy!r}")


def choose_by_bin(column: str, edges: Sequence[float], results: Sequence, missing) -> str:
    """SQL: ``results[i]`` for a value in bin i + 1, ``missing`` for none of the bins.

    Spark orders NaN above all numbers, so it is in none of the bins without a test of its own. One
    such test in every comparison makes the generated methods too long for the JVM to compile.
    """
    if len(edges) < 2:
        return sql.literal(missing)
    value, otherwise = f"cast({sql.name(column)} as double)", sql.literal(missing)
    chosen = [f"when {value} < {sql.number(edges[0])} then {otherwise}"]
    chosen += [
        f"when {value} <= {sql.number(edge)} then {sql.literal(result)}"
        for edge, result in zip(edges[1:], results)
    ]
    return f"case {' '.join(chosen)} else {otherwise} end"


def bin_number(column: str, edges: Sequence[float]) -> str:
    """SQL: 1, 2, ... for the bin that holds the value; null outside the edges."""
    return f"cast({choose_by_bin(column, edges, range(1, len(edges)), None)} as bigint)"


def assign_bins(df: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    return replace_columns(df, {c: bin_number(c, e) for c, e in edges.items()})


def edge_table(spark: SparkSession, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """The edges as rows (feature, edge_index, edge)."""
    rows = [(c, i, float(e)) for c, es in edges.items() for i, e in enumerate(es)]
    return spark.createDataFrame(rows, "feature string, edge_index bigint, edge double")
