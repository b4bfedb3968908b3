"""The exploration of a transaction table: profile it, cap it, write it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskframe.operators import distribution, profile
from riskframe.operators.winsorize import winsorize_iqr
from riskframe.schema import FRAUD
from riskframe.sources.files import write_csv


def profile_tables(df: DataFrame, exact: bool = True) -> dict[str, DataFrame]:
    """Every profile of the table by name. Each is computed when it is read."""
    return {
        "shape": profile.table_shape(df),
        "info": profile.column_info(df),
        "numeric": profile.describe_numeric(df, exact=exact),
        "categorical": profile.describe_categorical(df),
        "histogram": distribution.histogram(df),
        "kde": distribution.kde(df),
        "value_counts": profile.value_counts(df),
        "correlation": profile.correlation_matrix(df),
        "missing": profile.missing_report(df),
        "missing_pattern": profile.missing_pattern(df),
        "boxplot": profile.boxplot_stats(df, exact=exact),
        "constant": profile.constant_columns(df),
        "redundant": profile.redundant_pairs(df),
        "balance": profile.class_balance(df, FRAUD),
    }


def cap_and_write(df: DataFrame, path: str, exact: bool = True) -> DataFrame:
    """Cap the outliers of all numeric columns but the excluded ones and write CSV."""
    capped = winsorize_iqr(df, exact=exact)
    write_csv(capped, path)
    return capped
