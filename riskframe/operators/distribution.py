"""Histograms and kernel density curves.

Rows are reduced map-side before any shuffle: to bins, and for curves to distinct values
or cells and then to grid points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import doubles, melt, numeric_columns
from riskframe.operators.profile import per_column

BINS = 30
GRID = 200
# A Gaussian 8.5 deviations out is below 2e-16 of its peak, the precision of a double.
KERNEL_REACH = 8.5
# Cells per bandwidth of the inexact curve.
FINE = 64


def _ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, range and deviation of each column: one row per column."""
    return per_column(
        doubles(df, columns),
        columns,
        {
            "n": lambda c: f"count({c})",
            "lo": lambda c: f"min(cast({c} as double))",
            "hi": lambda c: f"max(cast({c} as double))",
            "sd": lambda c: f"stddev_samp({c})",
        },
    ).withColumnRenamed("column", "feature")


def _known(ranges: DataFrame) -> DataFrame:
    """The one row per column computed once: it is used on both sides of a join."""
    return ranges.sparkSession.createDataFrame(ranges.collect(), ranges.schema)


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = BINS) -> DataFrame:
    """Equal-width bins per numeric column, empty ones included; the last is closed.

    A column of one value gets the range of half a unit to either side.
    """
    columns = list(columns or numeric_columns(df))
    ranges = (
        _known(_ranges(df, columns))
        .filter("n > 0")
        .selectExpr(
            "feature", "if(lo = hi, lo - 0.5D, lo) as lo", "if(lo = hi, hi + 0.5D, hi) as hi"
        )
    )
    # One row per column and one per bin: both small whatever the table.
    counted = (
        melt(df, columns)
        .filter("value is not null")
        .join(F.broadcast(ranges), "feature")
        .selectExpr(
            "feature", f"least(floor((value - lo) / (hi - lo) * {bins}), {bins - 1}L) as bin"
        )
        .groupBy("feature", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = ranges.selectExpr(
        "feature",
        "lo",
        f"(hi - lo) / {bins} as width",
        f"explode(sequence(0L, {bins - 1}L)) as bin",
    )
    return frame.join(F.broadcast(counted), ["feature", "bin"], "left").selectExpr(
        "feature",
        "bin",
        "lo + bin * width as bin_start",
        "lo + (bin + 1) * width as bin_end",
        "coalesce(n, 0L) as n",
    )


def kde(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    grid: int = GRID,
    bins: int = BINS,
    reach: float = KERNEL_REACH,
    exact: bool = True,
) -> DataFrame:
    """Gaussian kernel density of each numeric column on a grid over its range.

    The bandwidth is n^(-1/5) times the sample deviation. ``curve`` is the density
    scaled to the counts of a histogram of ``bins`` bins. Equal values are merged first;
    a value adds only to the grid points its kernel reaches, and the sums combine
    map-side into the grid points. With ``exact=False`` values are first merged into
    ``FINE`` cells per bandwidth, which bounds the work by the range, not the rows; the
    density then differs by less than 1 / FINE^2 of its peak. Constant columns have no
    curve.
    """
    columns = list(columns or numeric_columns(df))
    ranges = (
        _known(_ranges(df, columns))
        .filter("sd > 0")
        .selectExpr(
            "feature",
            "n",
            "lo",
            "hi",
            f"(hi - lo) / {grid - 1} as step",
            "power(n, -0.2D) * sd as bandwidth",
        )
    )
    first = f"greatest(ceil((value - {reach}D * bandwidth - lo) / step), 0L)"
    last = f"least(floor((value + {reach}D * bandwidth - lo) / step), {grid - 1}L)"
    # One row per column and one per grid point: both small whatever the table.
    values = melt(df, columns).filter("value is not null").join(F.broadcast(ranges.drop("n", "hi")), "feature")
    if not exact:
        cell = f"lo + (floor((value - lo) / bandwidth * {FINE}) + 0.5D) * bandwidth / {FINE}"
        values = values.withColumn("value", F.expr(cell))
    sums = (
        values.groupBy("feature", "value", "lo", "step", "bandwidth")
        .agg(F.count(F.lit(1)).alias("weight"))
        .selectExpr("*", f"{first} as first", f"{last} as last")
        .filter("first <= last")
        .selectExpr("*", "explode(sequence(first, last)) as point")
        .selectExpr("feature", "point", "weight", "(lo + point * step - value) / bandwidth as u")
        .groupBy("feature", "point")
        .agg(F.expr("sum(weight * exp(-0.5D * u * u)) as total"))
    )
    frame = ranges.selectExpr("*", f"explode(sequence(0L, {grid - 1}L)) as point")
    return (
        frame.join(F.broadcast(sums), ["feature", "point"], "left")
        .selectExpr(
            "*", "coalesce(total, 0D) / (n * bandwidth * sqrt(2D * pi())) as density"
        )
        .selectExpr(
            "feature",
            "point",
            "lo + point * step as x",
            "density",
            f"density * n * (hi - lo) / {bins} as curve",
        )
    )
