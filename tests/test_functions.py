import datetime as dt

from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.plans import core


def test_surrogate_key_null_and_single(spark):
    row = spark.sql("select 'a' a, 'b' b, cast(null as string) n").select(
        fn.surrogate_key("a").alias("one"), fn.surrogate_key("a", "b").alias("two"), fn.surrogate_key("a", "n").alias("gone"),
        F.md5(F.lit("a")).alias("md5_a"), F.md5(F.lit("a_b")).alias("md5_ab"),
    ).first()
    assert row.one == row.md5_a and row.two == row.md5_ab and row.gone is None


def test_text_helpers(spark):
    df = spark.createDataFrame([(" YES ", "  "), ("1", " A@B.c "), ("no", None), (None, "x")], "flag string, email string")
    got = df.select(fn.is_truthy("flag"), fn.blank_to_null(fn.folded("email")), fn.email_hash("email").isNull()).collect()
    assert [tuple(r) for r in got] == [(True, None, True), (True, "a@b.c", False), (False, None, True), (False, "x", False)]
    long = spark.range(1).select(F.repeat(F.lit("x"), 2500).alias("t")).select(F.length(fn.raw_excerpt("t"))).first()[0]
    assert long == 2000


def test_money(spark):
    df = spark.createDataFrame([(1050, 0, 10, 4.0), (7, 2, 9, 0.0)], "cents long, zero long, stock long, rate double")
    got = df.select(fn.cents_to_dollars("cents"), fn.guarded_ratio("cents", "zero"), fn.whole_ratio("stock", "rate")).collect()
    assert [tuple(r) for r in got] == [(10.5, None, 2.0), (0.07, 3.5, None)]
    assert df.select(fn.cents_to_dollars("cents").alias("d")).dtypes == [("d", "double")]


def test_calendar_days_match_python(spark):
    bounds = spark.sql("select date'2024-01-01' first_day, date'2027-12-31' last_day")
    days = core.calendar(bounds).collect()
    assert len(days) == 1461
    for d in days:
        day = d["date"]
        sunday_zero = (day.weekday() + 1) % 7
        assert d.date_sk == int(day.strftime("%Y%m%d"))
        assert (d.day_of_week, d.day_name, d.month_name) == (sunday_zero, day.strftime("%A"), day.strftime("%B"))
        assert d.week_of_year == day.isocalendar().week
        assert d.is_weekend == (sunday_zero == 6) and d.is_weekend_fixed == (sunday_zero in (0, 6))
        assert d.fiscal_year == day.year + (day.month >= 10)
        assert d.fiscal_quarter == {10: 1, 11: 1, 12: 1, 1: 2, 2: 2, 3: 2, 4: 3, 5: 3, 6: 3}.get(day.month, 4)
    holidays = {d["date"] for d in days if d.is_holiday and d.year == 2025}
    assert holidays == {dt.date(2025, 1, 1), dt.date(2025, 7, 4), dt.date(2025, 11, 27), dt.date(2025, 12, 25)}


def test_days_between_counts_calendar_boundaries(spark):
    df = spark.sql("select timestamp_ntz'2026-01-01 23:00:00' a, timestamp_ntz'2026-01-04 01:00:00' b")
    assert df.select(fn.days_between("a", "b")).first()[0] == 3
