"""Marts after increments against marts built in full, and what an increment opens."""

import random
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import surrogate_key
from tidemark.plans import increments, marts, refresh
from tidemark.schemas import contract

MONTHS = 3


class Shop:
    """Random facts whose rows, customers and return days stay within one month each."""

    def __init__(self, spark, folder):
        random.seed(7)
        self.spark, self.folder = spark, folder
        self.orders, self.items, self.payments, self.returns = {}, {}, {}, {}
        for k in range(60 * MONTHS):
            self.order(f"o{k}", k % MONTHS, f"c{k % (8 * MONTHS)}")

    def at(self, month, day):
        return datetime(2024, month + 1, day + 1, 12)

    def order(self, o, month, customer, status=None):
        status = status or random.choice(["delivered", "shipped", "placed", "returned"])
        when = self.at(month, random.randrange(20))
        self.orders[o] = (customer, status, random.randrange(100, 9000), when, month)
        for j in range(random.randrange(4)):
            self.item(f"{o}-{j}", o, f"p{random.randrange(5)}", random.randrange(1, 4))
        for j in range(random.randrange(3)):
            self.payments[f"{o}-{j}"] = (o, random.choice(["settled", "failed", "refunded"]), random.randrange(50, 5000), when + timedelta(days=1), month)

    def item(self, i, o, product, quantity):
        price = random.randrange(100, 900)
        self.items[i] = (o, product, quantity, price, self.orders[o][3], self.orders[o][4])
        if random.random() < 0.4:
            self.returns[i] = (i, random.choice(["damaged", "wrong_item"]), 1, self.orders[o][3] + timedelta(days=2), self.orders[o][4])

    def frame(self, name):
        def sk(c):
            return surrogate_key(c)

        def key(c):
            return F.date_format(c, "yyyyMMdd").cast("bigint")

        rows = {"fct_orders": self.orders, "fct_order_items": self.items, "fct_payments": self.payments, "fct_returns": self.returns}[name]
        data = [(k, *v) for k, v in rows.items()]
        schema, columns = {
            "fct_orders": ("order_id string, customer_sk string, status string, total_amount_cents long, order_ts timestamp_ntz, m int", {
                "order_sk": sk("order_id"), "order_date_sk": key("order_ts"), "currency": F.lit("USD"), "updated_at": F.col("order_ts")}),
            "fct_order_items": ("item_id string, order_id string, product_sk string, quantity long, unit_price_cents long, updated_at timestamp_ntz, m int", {
                "order_item_sk": sk("item_id"), "order_sk": sk("order_id"), "line_amount_cents": F.col("quantity") * F.col("unit_price_cents")}),
            "fct_payments": ("payment_id string, order_id string, status string, amount_cents long, event_ts timestamp_ntz, m int", {
                "payment_sk": sk("payment_id"), "order_sk": sk("order_id"), "payment_date_sk": key("event_ts"), "method": F.lit("card"), "updated_at": F.col("event_ts")}),
            "fct_returns": ("return_id string, item_id string, reason string, quantity long, returned_at timestamp_ntz, m int", {
                "return_sk": sk("return_id"), "order_item_sk": sk("item_id"), "return_date_sk": key("returned_at"), "updated_at": F.col("returned_at")}),
        }[name]
        df = self.spark.createDataFrame(data, schema).withColumns(columns)
        fields = [f for f in contract(name).fields]
        missing = {f.name: F.lit(None) for f in fields if f.name not in df.columns}
        return df.withColumns(missing).select(*(F.col(f.name).cast(f.dataType) for f in fields), F.concat(F.lit("m"), F.col("m")).alias(increments.PARTITION))

    def fact(self, name):
        return increments.fact_table(self.spark, f"{self.folder}/facts/{name}", name)

    def merge(self):
        with ThreadPoolExecutor(4) as pool:
            return dict(zip(increments.FACTS, pool.map(lambda name: self.fact(name).merge(self.frame(name)), increments.FACTS)))

    def dimension(self, name):
        s = self.spark
        days = s.range(400).select((F.lit("2023-12-01").cast("date") + F.col("id").cast("int")).alias("date"))
        return {
            "dim_date": lambda: days.select(
                F.date_format("date", "yyyyMMdd").cast("bigint").alias("date_sk"), "date", F.year("date").cast("smallint").alias("year"),
                F.month("date").cast("smallint").alias("month"), F.quarter("date").cast("smallint").alias("quarter"), F.date_format("date", "MMMM").alias("month_name")),
            "dim_customer": lambda: s.range(8 * MONTHS).select(F.concat(F.lit("c"), F.col("id")).alias("customer_sk"), F.concat(F.lit("r"), F.col("id") % 3).alias("region_sk")),
            "dim_region": lambda: s.range(3).select(F.concat(F.lit("r"), F.col("id")).alias("region_sk"), F.concat(F.lit("region"), F.col("id")).alias("region_name"), F.lit("US").alias("country")),
            "dim_product": lambda: s.range(5).select(F.concat(F.lit("p"), F.col("id")).alias("product_sk"), F.col("id").cast("string").alias("product_id"), F.lit("n").alias("name"), F.concat(F.lit("cat"), F.col("id") % 2).alias("category"), F.lit("b").alias("brand")),
            "inventory": lambda: s.range(5).select(F.col("id").cast("string").alias("product_id"), F.lit("w").alias("warehouse_id"), F.lit(40).cast("bigint").alias("stock_on_hand"), F.lit(5).cast("bigint").alias("reorder_point"), F.lit("2024-06-01").cast("timestamp_ntz").alias("updated_at")),
        }[name]()

    def full(self):
        o, i, p, r = (self.fact(n).read() for n in ("fct_orders", "fct_order_items", "fct_payments", "fct_returns"))
        d = self.dimension
        return {
            "mart_sales": marts.mart_sales(o, p, r, i, d("dim_date"), d("dim_customer"), d("dim_region")),
            "mart_customer_retention": marts.mart_customer_retention(o, d("dim_customer")),
            "mart_product_performance": marts.mart_product_performance(d("dim_product"), i, o, r),
            "mart_returns": marts.mart_returns(r, i, o, d("dim_product"), d("dim_customer"), d("dim_region"), d("dim_date")),
            "mart_inventory": marts.mart_inventory(d("inventory"), d("dim_product"), i, o),
        }


@pytest.fixture()
def shop(spark, tmp_path):
    shop = Shop(spark, str(tmp_path))
    shop.merge()
    return shop


def test_increments_equal_full_builds_and_open_only_what_they_touch(spark, shop, rows, tmp_path):
    kept = refresh.Marts(spark, f"{shop.folder}/marts", f"{shop.folder}/facts", shop.dimension)

    kept.refresh()
    for name, df in shop.full().items():
        assert rows(kept.read(name).select(*df.columns)) == rows(df), name
    assert kept.refresh() == {}

    # Orders of the last month change status, customer and items; others come.
    last = MONTHS - 1
    ids = [o for o, v in shop.orders.items() if v[4] == last]
    shop.orders[ids[0]] = (shop.orders[ids[0]][0], "returned", *shop.orders[ids[0]][2:])
    shop.orders[ids[1]] = (f"c{last}", "delivered", 77, *shop.orders[ids[1]][3:])
    shop.order("new1", last, f"c{last + MONTHS}", "shipped")
    shop.order("new2", last, f"c{last}", "delivered")
    shop.item("new1-x", "new1", "p4", 2)
    for i in [i for i, v in shop.items.items() if v[0] == ids[2]]:
        shop.items[i] = (*shop.items[i][:2], 3, *shop.items[i][3:])
    for name in increments.FACTS:
        assert shop.fact(name).merge(shop.frame(name).where(F.col(increments.PARTITION) == f"m{last}")) == 1

    # All partitions of the facts but the last turn to rubbish: none of them is opened.
    want = {name: rows(df) for name, df in shop.full().items()}
    spoilt = 0
    for name in increments.FACTS:
        for part in shop.fact(name).parts().where(F.col("value") != f"m{last}").collect():
            for file in (tmp_path / "facts" / name / part.folder).glob("*.parquet"):
                file.write_bytes(b"rubbish")
                spoilt += 1
    assert spoilt >= 4 * last
    written = kept.refresh()
    for name, expected in want.items():
        assert rows(kept.read(name).select(*contract(name).fieldNames())) == expected, name
    # One month of sales, and the months of the changed customers' cohorts, which lie in it.
    assert written["mart_sales"] == 1 and written["order_products"] == 1 and written["mart_returns"] <= 2 and written["mart_customer_retention"] == 1
