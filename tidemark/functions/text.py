from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RAW_EXCERPT_CHARS = 2000


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def tidy(value) -> Column:
    return F.trim(_column(value))


def folded(value) -> Column:
    """Trimmed and lower-cased, so casing variants collapse."""
    return F.lower(tidy(value))


def blank_to_null(value) -> Column:
    return F.nullif(_column(value), F.lit(""))


def is_truthy(value) -> Column:
    """true / 1 / yes in any casing; everything else, NULL too, is false."""
    return F.coalesce(folded(value).isin("true", "1", "yes"), F.lit(False))


def raw_excerpt(value) -> Column:
    """The beginning of a long text, for display. Stored records stay whole."""
    return F.substring(_column(value), 1, RAW_EXCERPT_CHARS)


def email_hash(value) -> Column:
    return F.sha2(blank_to_null(folded(value)), 256)
