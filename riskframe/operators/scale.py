"""Standardizing with the population deviation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from riskframe.functions import sql
from riskframe.functions.columns import replace_columns


def _scaled(c: str, mean: float, std: float) -> str:
    if std == 0:
        return f"if({sql.name(c)} is null, null, 0D)"
    return f"({sql.as_double(c)} - {sql.number(mean)}) / {sql.number(std)}"


class _Columns(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns scaled", TypeConverters.toListString)


class PopulationScalerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "fitted means", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "fitted deviations", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        fitted = zip(
            self.getOrDefault(self.inputCols),
            self.getOrDefault(self.means),
            self.getOrDefault(self.stds),
        )
        return replace_columns(df, {c: _scaled(c, m, s) for c, m, s in fitted})


class PopulationScaler(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population deviation; a constant column becomes 0.

    ``pyspark.ml.feature.StandardScaler`` divides by the sample deviation instead.
    """

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PopulationScalerModel:
        columns = self.getOrDefault(self.inputCols)
        row = df.selectExpr(
            *[f"struct(avg({v}) as mean, stddev_pop({v}) as std) as {v}" for v in map(sql.name, columns)]
        ).first()
        model = PopulationScalerModel()
        model._set(
            inputCols=columns,
            means=[row[c]["mean"] or 0.0 for c in columns],
            stds=[row[c]["std"] or 0.0 for c in columns],
        )
        return model


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return PopulationScaler(inputCols=list(columns)).fit(df).transform(df)
