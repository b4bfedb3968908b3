"""Weight of evidence.

Per bin: the share of all non-events over the share of all events, as logarithm,
with either count floored at one half. A missing value is a bin of its own, named
``nan``. Numeric columns have a bounded number of bins, which the model holds as
parameters; text columns may have any number of categories, which it holds as a
table.
"""

from __future__ import annotations

import json
import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions import sql
from riskframe.functions.columns import replace_columns
from riskframe.functions.scalars import as_category
from riskframe.operators.binning import assign_bins, choose_by_bin, fit_edges
from riskframe.schema import LABEL
from riskframe.session import stage

MISSING = "nan"
FLOOR = 0.5
# Categories broadcast at most, over all text columns of one model.
MAX_BROADCAST = 100_000
SALTS = 16

TABLE_SCHEMA = (
    "feature string, bin string, n bigint, events bigint, non_events bigint, woe double"
)


def bin_counts(df: DataFrame, columns, label_col: str) -> DataFrame:
    """(feature, bin, n, events) for columns that already hold bins, in one grouping.

    Rows combine map-side into (feature, bin), so no rows are shuffled.
    """
    as_text = df.selectExpr(
        f"cast({sql.name(label_col)} as bigint) as _y",
        *[
            f"coalesce(cast({v} as string), {sql.text(MISSING)}) as {v}"
            for v in map(sql.name, columns)
        ],
    )
    return (
        as_text.unpivot(["_y"], list(columns), "feature", "bin")
        .groupBy("feature", "bin")
        .agg(
            F.count("_y").alias("n"),
            F.coalesce(F.sum("_y"), F.lit(0)).cast("bigint").alias("events"),
        )
    )


def _woe(events: int, non_events: int, all_events: int, all_non_events: int) -> float:
    share_of_events = max(events, FLOOR) / all_events
    share_of_non_events = max(non_events, FLOOR) / all_non_events
    return math.log(share_of_non_events / share_of_events)


def _woe_column(all_events: int, all_non_events: int):
    events = F.greatest("events", F.lit(FLOOR)) / F.lit(float(all_events))
    non_events = F.greatest("non_events", F.lit(FLOOR)) / F.lit(float(all_non_events))
    return F.log(non_events / events)


class _WoeParams(Params):
    inputCols = Param(
        Params._dummy(), "inputCols", "numeric columns to bin", TypeConverters.toListString
    )
    categoryCols = Param(
        Params._dummy(), "categoryCols", "columns used as categories", TypeConverters.toListString
    )
    fillValue = Param(
        Params._dummy(), "fillValue", "value of a bin not seen in the fit", TypeConverters.toFloat
    )


class _ModelWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        if self.instance.categories is not None:
            self.instance.categories.write.parquet(f"{path}/categories")


class _ModelReader(DefaultParamsReader):
    def load(self, path: str) -> WoeEncoderModel:
        model = super().load(path)
        if model.getOrDefault(model.categoryCols):
            spark = SparkSession.active()
            model.categories = spark.read.schema(TABLE_SCHEMA).parquet(f"{path}/categories")
        return model


class WoeEncoderModel(Model, _WoeParams, DefaultParamsReadable, DefaultParamsWritable):
    """Replaces each value by the weight of evidence of its bin."""

    binEdges = Param(Params._dummy(), "binEdges", "JSON: edges", TypeConverters.toString)
    binTable = Param(Params._dummy(), "binTable", "JSON: rows of bins", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(inputCols=[], categoryCols=[], fillValue=0.0, binEdges="{}", binTable="[]")
        self.categories: DataFrame | None = None

    def write(self):
        return _ModelWriter(self)

    @classmethod
    def read(cls):
        return _ModelReader(cls)

    def edges(self) -> dict[str, list[float]]:
        return json.loads(self.getOrDefault(self.binEdges))

    def table(self) -> DataFrame:
        """The fitted bins of all columns."""
        rows = [tuple(r) for r in json.loads(self.getOrDefault(self.binTable))]
        fitted = SparkSession.active().createDataFrame(rows, TABLE_SCHEMA)
        return fitted if self.categories is None else fitted.unionByName(self.categories)

    def _numeric(self, df: DataFrame) -> DataFrame:
        fill = self.getOrDefault(self.fillValue)
        woe = {(r[0], r[1]): r[5] for r in json.loads(self.getOrDefault(self.binTable))}
        encoded = {}
        for c, edges in self.edges().items():
            if c in df.columns:
                by_bin = [woe.get((c, str(i)), fill) for i in range(1, len(edges))]
                encoded[c] = choose_by_bin(c, edges, by_bin, woe.get((c, MISSING), fill))
        return replace_columns(df, encoded) if encoded else df

    def _category(self, df: DataFrame, column: str, fill: float) -> DataFrame:
        """Look one text column up in the table of categories.

        The most frequent categories are broadcast (a bounded number of them), which
        keeps hot categories out of any shuffle. Where that leaves rare ones, the rows
        without a hit look those up in a shuffled join under a salted key, so that a
        frequent category that was not seen at the fit is spread; the salt is a hash of the
        row, so a task that runs again salts alike. Each rare category is repeated once per salt. Rows already resolved take part under a key of their own.
        """
        lookup = self.categories.filter(F.col("feature") == column).select(
            F.col("bin").alias("_bin"), F.col("woe").alias("_woe"), "n"
        )
        share = max(1, MAX_BROADCAST // len(self.getOrDefault(self.categoryCols)))
        all_fit = lookup.limit(share + 1).count() <= share
        frequent = lookup
        if not all_fit:
            frequent = lookup.orderBy(F.desc("n"), "_bin").limit(share)
        columns = df.columns
        keyed = df.withColumn("_key", as_category(column))
        hit = keyed.join(
            F.broadcast(frequent.select(F.col("_bin").alias("_key"), "_woe")), "_key", "left"
        )
        found = F.col("_woe")
        if not all_fit:
            rare = lookup.join(F.broadcast(frequent.select("_bin")), "_bin", "left_anti")
            own = F.concat(F.lit("\u0000"), F.xxhash64(*columns).cast("string"))
            salted = rare.select(
                F.col("_bin").alias("_key"),
                F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"),
                F.col("_woe").alias("_rare"),
            )
            hit = (
                hit.withColumn("_key", F.when(F.col("_woe").isNull(), F.col("_key")).otherwise(own))
                .withColumn("_salt", F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int"))
                .join(salted, ["_key", "_salt"], "left")
            )
            found = F.coalesce("_woe", "_rare")
        return hit.withColumn(column, F.coalesce(found, F.lit(fill))).select(*columns)

    def _transform(self, df: DataFrame) -> DataFrame:
        df = self._numeric(df)
        fill = self.getOrDefault(self.fillValue)
        for c in self.getOrDefault(self.categoryCols):
            if c in df.columns:
                df = self._category(df, c, fill)
        return df


class WoeEncoder(Estimator, _WoeParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits edges and weights of evidence against a 0/1 label column.

    ``inputCols`` are binned, ``categoryCols`` are used as they are; other columns
    pass through. Rows without a label count in no bin.
    """

    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    bins = Param(Params._dummy(), "bins", "bins per column", TypeConverters.toInt)
    strategy = Param(Params._dummy(), "strategy", "quantile or uniform", TypeConverters.toString)
    exact = Param(Params._dummy(), "exact", "exact quantiles", TypeConverters.toBoolean)

    @keyword_only
    def __init__(
        self,
        *,
        inputCols=None,
        categoryCols=None,
        labelCol=LABEL,
        bins=10,
        fillValue=0.0,
        strategy="quantile",
        exact=True,
    ):
        super().__init__()
        self._setDefault(
            inputCols=[],
            categoryCols=[],
            labelCol=LABEL,
            bins=10,
            fillValue=0.0,
            strategy="quantile",
            exact=True,
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> WoeEncoderModel:
        numeric = self.getOrDefault(self.inputCols)
        text = self.getOrDefault(self.categoryCols)
        label = self.getOrDefault(self.labelCol)
        if not numeric and not text:
            raise ValueError("no columns to encode")
        edges = {}
        if numeric:
            edges = fit_edges(
                df,
                numeric,
                self.getOrDefault(self.bins),
                self.getOrDefault(self.strategy),
                self.getOrDefault(self.exact),
            )
        counted = []
        if numeric:
            # At most bins + 1 rows per column; the bins of one column hold all rows.
            counted = (
                bin_counts(assign_bins(df, edges), numeric, label)
                .orderBy("feature", "bin")
                .collect()
            )
            one = [r for r in counted if r["feature"] == numeric[0]]
            all_rows, all_events = sum(r["n"] for r in one), sum(r["events"] for r in one)
        else:
            all_rows, all_events = df.agg(
                F.count(label), F.coalesce(F.sum(label), F.lit(0))
            ).first()
        all_non_events = all_rows - all_events
        if all_events == 0 or all_non_events == 0:
            raise ValueError(
                f"label {label!r} needs both classes: {all_events} events, "
                f"{all_non_events} non-events"
            )
        rows = []
        for r in counted:
            non_events = r["n"] - r["events"]
            woe = _woe(r["events"], non_events, all_events, all_non_events)
            rows.append((r["feature"], r["bin"], r["n"], r["events"], non_events, woe))
        model = WoeEncoderModel()
        if text:
            categories = bin_counts(df, text, label).withColumn(
                "non_events", F.col("n") - F.col("events")
            )
            fitted = categories.withColumn("woe", _woe_column(all_events, all_non_events))
            model.categories = stage(
                fitted.select("feature", "bin", "n", "events", "non_events", "woe"), "woe"
            )
        return model._set(
            inputCols=numeric,
            categoryCols=text,
            fillValue=self.getOrDefault(self.fillValue),
            binEdges=json.dumps(edges),
            binTable=json.dumps(rows),
        )
