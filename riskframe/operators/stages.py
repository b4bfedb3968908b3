"""The customer aggregation as a pipeline stage."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from riskframe.functions.columns import round_doubles
from riskframe.operators.features import customer_features
from riskframe.schema import CUSTOMER_ID, START_TIME


class CustomerFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Transactions in, one feature row per customer out.

    The row grain changes, so this is the first stage of a pipeline, and a label is
    joined to its output by key. ``keys`` are grouped on beside the customer where
    the input has them. ``digits`` rounds sums, means and deviations: their last digits
    depend on the order of summing, and a value on the edge of a bin would fall to either side.
    """

    customerIdCol = Param(Params._dummy(), "customerIdCol", "customer", TypeConverters.toString)
    timestampCol = Param(Params._dummy(), "timestampCol", "time", TypeConverters.toString)
    keys = Param(Params._dummy(), "keys", "further keys", TypeConverters.toListString)
    exactDistinct = Param(
        Params._dummy(), "exactDistinct", "exact distinct counts", TypeConverters.toBoolean
    )

    onBadTimestamp = Param(
        Params._dummy(), "onBadTimestamp", "null or raise", TypeConverters.toString
    )
    formats = Param(
        Params._dummy(), "formats", "date patterns tried after ISO", TypeConverters.toListString
    )

    digits = Param(Params._dummy(), "digits", "digits kept after the point, -1 for all", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self,
        *,
        customerIdCol=CUSTOMER_ID,
        timestampCol=START_TIME,
        keys=None,
        exactDistinct=True,
        onBadTimestamp="null",
        formats=None,
        digits=None,
    ):
        super().__init__()
        self._setDefault(
            customerIdCol=CUSTOMER_ID,
            timestampCol=START_TIME,
            keys=[],
            exactDistinct=True,
            onBadTimestamp="null",
            formats=[],
            digits=-1,
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        made = customer_features(
            df,
            customer_id_col=self.getOrDefault(self.customerIdCol),
            timestamp_col=self.getOrDefault(self.timestampCol),
            keys=[k for k in self.getOrDefault(self.keys) if k in df.columns],
            exact_distinct=self.getOrDefault(self.exactDistinct),
            on_bad_timestamp=self.getOrDefault(self.onBadTimestamp),
            formats=self.getOrDefault(self.formats),
        )
        digits = self.getOrDefault(self.digits)
        return made if digits < 0 else round_doubles(made, digits)
