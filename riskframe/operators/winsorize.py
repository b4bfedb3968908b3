"""Capping of outliers at the quartile fences."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from riskframe.functions.columns import numeric_columns
from riskframe.functions.scalars import clamp
from riskframe.operators.quantiles import quantiles
from riskframe.schema import FRAUD

# Columns that are not capped by default.
NOT_CAPPED = (FRAUD, "CountryCode")
REACH = 1.5


def cappable_columns(df: DataFrame, exclude: Iterable[str] = NOT_CAPPED) -> list[str]:
    return numeric_columns(df, exclude)


def fences(
    df: DataFrame, columns: Sequence[str], exact: bool = True, reach: float = REACH
) -> dict[str, tuple[float, float, float, float]]:
    """First and third quartile and the two fences of each column that has values."""
    found = {}
    for c, (q1, q3) in quantiles(df, columns, [0.25, 0.75], exact).items():
        if q1 is not None:
            found[c] = (q1, q3, q1 - reach * (q3 - q1), q3 + reach * (q3 - q1))
    return found


class _Bounds(Params):
    columns = Param(Params._dummy(), "columns", "columns capped", TypeConverters.toListString)
    lower = Param(Params._dummy(), "lower", "lower fences", TypeConverters.toListFloat)
    upper = Param(Params._dummy(), "upper", "upper fences", TypeConverters.toListFloat)


class IqrCapperModel(Model, _Bounds, DefaultParamsReadable, DefaultParamsWritable):
    """Holds the fitted fences and clamps each column to them, as double."""

    def bounds(self) -> dict[str, tuple[float, float]]:
        names = self.getOrDefault(self.columns)
        return {
            c: (lo, hi)
            for c, lo, hi in zip(
                names, self.getOrDefault(self.lower), self.getOrDefault(self.upper)
            )
        }

    def _transform(self, df: DataFrame) -> DataFrame:
        capped = {c: clamp(c, lo, hi) for c, (lo, hi) in self.bounds().items()}
        return df.withColumns(capped) if capped else df


class IqrCapper(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the fences of the numeric columns, leaving out ``exclude``."""

    exclude = Param(Params._dummy(), "exclude", "columns left alone", TypeConverters.toListString)
    exact = Param(Params._dummy(), "exact", "exact quartiles", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, exclude=None, exact=True):
        super().__init__()
        self._setDefault(exclude=list(NOT_CAPPED), exact=True)
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**given)

    def _fit(self, df: DataFrame) -> IqrCapperModel:
        columns = cappable_columns(df, self.getOrDefault(self.exclude))
        found = fences(df, columns, self.getOrDefault(self.exact))
        model = IqrCapperModel()
        model._set(
            columns=list(found),
            lower=[f[2] for f in found.values()],
            upper=[f[3] for f in found.values()],
        )
        return model


def winsorize_iqr(df: DataFrame, exclude: Iterable[str] = NOT_CAPPED, exact: bool = True) -> DataFrame:
    return IqrCapper(exclude=list(exclude), exact=exact).fit(df).transform(df)
