"""Column expressions. All of them stay inside generated JVM code; there is no Python UDF."""

from tidemark.functions.dates import calendar_columns, day_of_week, days_between, month_start
from tidemark.functions.keys import packed, plain_key, row_digest, surrogate_key, unpacked
from tidemark.functions.money import cents_to_dollars, guarded_ratio, whole_ratio
from tidemark.functions.text import blank_to_null, email_hash, folded, is_truthy, raw_excerpt, tidy

__all__ = [
    "blank_to_null", "calendar_columns", "cents_to_dollars", "day_of_week", "days_between", "email_hash",
    "folded", "guarded_ratio", "is_truthy", "month_start", "packed", "plain_key", "raw_excerpt", "row_digest",
    "surrogate_key", "tidy", "unpacked", "whole_ratio",
]
