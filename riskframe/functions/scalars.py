"""Column expressions. Each returns a Column; none of them runs Python per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def clamp(c: Column | str, lower: Column | float, upper: Column | float) -> Column:
    """``c`` held inside [lower, upper]; a missing value (null or NaN) is null.

    ``greatest``/``least`` skip nulls and would turn a missing value into a bound.
    """
    c = nan_to_null(_col(c).cast("double"))
    lo = lower if isinstance(lower, Column) else F.lit(float(lower))
    hi = upper if isinstance(upper, Column) else F.lit(float(upper))
    return F.when(c < lo, lo).when(c > hi, hi).otherwise(c)


def flag_equal(a: Column | str, b: Column | str) -> Column:
    """1 where the two are equal, else 0 (also where one is missing)."""
    return F.coalesce((_col(a) == _col(b)).cast("int"), F.lit(0))


def fill(c: Column | str, value) -> Column:
    return F.coalesce(_col(c), F.lit(value))


def as_category(c: Column | str) -> Column:
    """The value as text; a missing value becomes the category ``nan``."""
    return F.coalesce(_col(c).cast("string"), F.lit("nan"))


def lenient_timestamp(c: Column | str, formats: Sequence[str] = ()) -> Column:
    """Text to timestamp, null where it does not parse.

    ISO text is read by the cast; ``formats`` are tried in turn after it. No
    session time zone takes part: the result is the wall-clock time as written.
    """
    c = _col(c)
    parsed = [c.try_cast("timestamp_ntz")]
    parsed += [F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*parsed) if len(parsed) > 1 else parsed[0]


def strict_timestamp(c: Column | str, formats: Sequence[str] = ()) -> Column:
    """Text to timestamp; text that does not parse fails the job (null stays null)."""
    c = _col(c)
    parsed = lenient_timestamp(c, formats)
    bad = c.isNotNull() & parsed.isNull()
    message = F.concat(F.lit("not a timestamp: "), c.cast("string"))
    return F.when(bad, F.raise_error(message).cast("timestamp_ntz")).otherwise(parsed)


def hour(c: Column | str) -> Column:
    return F.hour(_col(c)).cast("bigint")


def day(c: Column | str) -> Column:
    return F.dayofmonth(_col(c)).cast("bigint")


def month(c: Column | str) -> Column:
    return F.month(_col(c)).cast("bigint")


def year(c: Column | str) -> Column:
    return F.year(_col(c)).cast("bigint")


def plus_one_day(c: Column | str) -> Column:
    return _col(c) + F.expr("INTERVAL 1 DAY")


def elapsed_days(start: Column | str, end: Column | str) -> Column:
    """Whole days that have passed between two times.

    ``datediff`` would count calendar days: one second across midnight is 0 here.
    """
    return F.timestamp_diff("DAY", _col(start), _col(end))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, null where the divisor is 0."""
    return F.try_divide(_col(numerator), _col(denominator))


def percent(numerator: Column | str, denominator: Column | str) -> Column:
    return ratio(_col(numerator) * F.lit(100.0), denominator)


def class_probability(probability: Column | str, index: int = 1) -> Column:
    """Element ``index`` of a classifier's probability vector."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(_col(probability))[index]
