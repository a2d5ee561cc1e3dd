"""Kept sums against sums over the rows, and what a refresh opens."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans import reports
from tidemark.plans.summaries import SUMMARIES, Summaries, merged, partial_sums, totals
from tidemark.sources.commits import Conflict
from tidemark.sources.tables import ManifestTable

SALES = "order_sk string, date date, year int, month int, region_name string, total_amount_cents long, net_revenue double, returned_revenue double, m string"


def sales(spark, numbers, change=0):
    rng, rows = random.Random(5), []
    for k in numbers:
        cents, day = rng.randrange(100, 9000) + change, rng.randrange(1, 9)
        net = None if k % 7 == 0 else cents / 100
        rows.append((f"o{k}", None if k % 31 == 0 else f"2024-0{k % 3 + 1}-0{day}", 2024, k % 3 + 1, rng.choice(["N", "S", None]), cents, net, 0.0, f"m{k % 3}"))
    raw = spark.createDataFrame([tuple(r) for r in rows], SALES.replace("date date", "date string"))
    return raw.withColumn("date", F.col("date").cast("date"))


@pytest.fixture()
def kept(spark, tmp_path):
    table = ManifestTable(spark, str(tmp_path / "mart_sales"), keys=("order_sk",), partition_by=("m",), indexed=("order_sk",))
    return table, Summaries(spark, str(tmp_path / "summaries"), lambda name: table)


def same(rows, kept, name, df):
    assert rows(kept.read(name)) == rows(totals(partial_sums(df, SUMMARIES[name]), SUMMARIES[name]))


def test_sums_follow_merges_and_open_only_what_they_changed(spark, rows, kept, tmp_path):
    table, sums = kept
    table.merge(sales(spark, range(200)))
    for name in ("sales_by_day", "sales_by_month"):
        assert sums.refresh(name) > 0
        same(rows, sums, name, table.read())
        assert sums.refresh(name) == 0

    # Rows of one partition change, others come and a whole region and day go.
    table.merge(sales(spark, range(0, 60, 3), change=11).unionByName(sales(spark, range(300, 330, 3))))
    gone = table.read().where("m = 'm0' and region_name = 'N'").select("order_sk")
    table.replace("order_sk", gone, table.read().limit(0))
    want = {name: rows(totals(partial_sums(table.read(), SUMMARIES[name]), SUMMARIES[name])) for name in ("sales_by_day", "sales_by_month")}
    untouched = table.parts().where("value <> 'm0'").collect()
    assert len(untouched) == 2
    for part in untouched:
        for file in (tmp_path / "mart_sales" / part.folder).glob("*.parquet"):
            file.write_bytes(b"rubbish")
    for name, expected in want.items():
        assert sums.refresh(name) > 0
        assert rows(sums.read(name)) == expected


def test_a_group_without_values_has_no_sum_again(spark, rows, kept):
    table, sums = kept
    first = spark.createDataFrame([("a", None, 2024, 1, "N", 5, None, None, "m0"), ("b", None, 2024, 1, "N", None, 2.0, None, "m0")], SALES)
    table.merge(first)
    sums.refresh("sales_by_month")
    assert rows(sums.read("sales_by_month").select("row_count", "gross_cents", "net_cents", "returned_cents")) == [(2, 5, 200, None)]
    table.replace("order_sk", spark.sql("select 'b' k"), first.limit(0))
    assert sums.refresh("sales_by_month") == 1
    assert rows(sums.read("sales_by_month").select("row_count", "gross_cents", "net_cents", "returned_cents")) == [(1, 5, None, None)]
    table.replace("order_sk", spark.sql("select 'a' k"), first.limit(0))
    assert sums.refresh("sales_by_month") == 1 and sums.read("sales_by_month").count() == 0


def test_the_second_of_two_refreshes_fails_whole(spark, rows, kept, monkeypatch):
    table, sums = kept
    table.merge(sales(spark, range(50)))
    other, fired = Summaries(spark, sums.root, sums.source), []
    keep = Summaries._kept

    def in_between(self, df, name):
        if self is sums and not fired:
            fired.append(other.refresh(name))
        return keep(self, df, name)

    monkeypatch.setattr(Summaries, "_kept", in_between)
    with pytest.raises(Conflict):
        sums.refresh("sales_by_day")
    assert fired and fired[0] > 0
    same(rows, sums, "sales_by_day", table.read())


def test_parts_merge_into_the_whole(spark, rows):
    df, summary = sales(spark, range(120)), SUMMARIES["sales_by_month"]
    parts = [partial_sums(df.where(f"crc32(order_sk) % 3 = {k}"), summary) for k in range(3)]
    assert rows(merged(parts[0].unionByName(parts[1]).unionByName(parts[2]), summary)) == rows(partial_sums(df, summary))


def test_reports_exchange_once_at_most(spark, kept):
    table, sums = kept
    table.merge(sales(spark, range(50)))
    for name in ("sales_by_day", "sales_by_month"):
        sums.refresh(name)
    plans = {
        "daily_net_revenue": reports.daily_net_revenue(sums.read("sales_by_day")), "daily_aov": reports.daily_aov(sums.read("sales_by_day")),
        "monthly": reports.monthly_revenue_by_region(sums.read("sales_by_month")), "impact": reports.return_impact(sums.read("sales_by_month")),
    }
    for name, df in plans.items():
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange ") <= 1, name
