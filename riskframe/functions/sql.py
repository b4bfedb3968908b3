"""Names and numbers as SQL text.

Wide expressions (one per column, pair or bin edge) are written as SQL text: a whole
projection is then handed to Spark in one call instead of one call per operator.
"""

from __future__ import annotations

import math


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def number(value: float | None) -> str:
    """A double literal that reads back as the same double."""
    if value is None:
        return "cast(null as double)"
    value = float(value)
    if math.isnan(value):
        return "double('NaN')"
    if math.isinf(value):
        return f"double('{'-' if value < 0 else ''}Infinity')"
    return f"{value!r}D"


def literal(value) -> str:
    """A literal of the value's own kind."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return number(value)
    return text(str(value))


def as_double(column: str) -> str:
    """The column as double, NaN as null: there is one marker for a missing number."""
    return f"nullif(cast({name(column)} as double), double('NaN'))"
