from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import _column


def month_start(value) -> Column:
    return F.trunc(_column(value).cast("date"), "month")


def days_between(start, end) -> Column:
    """Calendar days crossed, not full 24-hour spans."""
    return F.datediff(_column(end), _column(start)).cast("bigint")


def day_of_week(day) -> Column:
    """Sunday = 0 … Saturday = 6."""
    return F.dayofweek(_column(day)) - 1


def calendar_columns(day_column: str) -> dict[str, Column]:
    """The attributes of one calendar day.

    Fixed values: weekday numbers start at Sunday = 0 and ``is_weekend`` tests them for 6 and 7, so only
    Saturday is flagged; ``is_weekend_fixed`` covers both days. Holidays: 1 January, 4 July,
    25 December and the Thursday within 22-28 November. The fiscal year starts in October.
    """
    day = F.col(day_column)
    year, month, dom, dow = F.year(day), F.month(day), F.dayofmonth(day), day_of_week(day)
    month_day = month * 100 + dom
    thanksgiving = (dow == 4) & month_day.between(1122, 1128)
    starts_fiscal_year = month >= 10
    return {
        "date_sk": (year * 10000 + month_day).cast("bigint"),
        "date": day,
        "year": year.cast("smallint"),
        "quarter": F.quarter(day).cast("smallint"),
        "month": month.cast("smallint"),
        "month_name": F.date_format(day, "MMMM"),
        "day": dom.cast("smallint"),
        "day_of_week": dow.cast("smallint"),
        "day_name": F.date_format(day, "EEEE"),
        "week_of_year": F.weekofyear(day).cast("smallint"),
        "is_weekend": dow.isin(6, 7),
        "is_weekend_fixed": dow.isin(0, 6),
        "is_holiday": month_day.isin(101, 704, 1225) | thanksgiving,
        "fiscal_year": (year + starts_fiscal_year.cast("int")).cast("bigint"),
        "fiscal_quarter": F.quarter(F.add_months(day, 3)),
    }
