from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import _column


def cents_to_dollars(cents) -> Column:
    """Money stays in integer cents until here. ``lit(100.0)`` is a double, so the result is a double
    and not a decimal."""
    return _column(cents) / F.lit(100.0)


def guarded_ratio(numerator, denominator) -> Column:
    """NULL instead of an error where the denominator is zero."""
    return _column(numerator).cast("double") / F.nullif(_column(denominator).cast("double"), F.lit(0.0))


def whole_ratio(numerator, denominator) -> Column:
    """Rounded down, as a double; NULL unless the denominator is positive."""
    bottom = _column(denominator)
    return F.when(bottom > 0, F.floor(_column(numerator) / bottom).cast("double"))
