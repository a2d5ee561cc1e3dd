"""Parents looked up without moving the rows that have them, and marts from facts that carry their parents' columns."""

import re

from pyspark.sql import functions as F

from conftest import SF
from tidemark.catalog.warehouse import Warehouse
from tidemark.functions import unpacked
from tidemark.operators.joins import with_known
from tidemark.plans import core, marts, refresh


def test_rows_with_a_known_key_are_those_of_the_join_and_stay_in_place(spark, rows, tmp_path):
    facts = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("c", 5), ("c", 5)], "k string, n int")
    parent = spark.createDataFrame([("a",), ("c",), (None,), ("z",)], "k string")
    more = facts.select("k").unionByName(spark.createDataFrame([("y",)], "k string"))

    def stage(df, name):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    found = with_known(facts, "k", parent, more, stage)
    assert rows(found) == rows(facts.join(parent, "k").select("k", "n"))
    assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_parent_meets_the_keys_in_one_exchange(spark, tmp_path):
    keys, parent = (spark.createDataFrame([(n,) for n in ids], "k long") for ids in (range(9), range(3, 7)))
    plans = []

    def stage(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert [r.k for r in with_known(keys, "k", parent, keys, stage).sort("k").collect()] == [3, 4, 5, 6]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plans[0].count("hashpartitioning") == 2  # one of the keys, one of the parent


def test_marts_from_carried_columns_are_those_from_the_parents(spark, rows):
    w = Warehouse(spark, SF)
    assert set(marts.OF_CUSTOMER) <= set(w.carrying("fct_orders").columns) and not set(marts.OF_CUSTOMER) & set(w.table("fct_orders").columns)
    built = []
    for t in (w.keyed, w.carrying):
        o, i, p, r = (t(n) for n in ("fct_orders", "fct_order_items", "fct_payments", "fct_returns"))
        dims = [t(n) for n in ("dim_product", "dim_customer", "dim_region", "dim_date")]
        built.append((
            rows(marts.mart_sales(o, p, r, i, dims[3], dims[1], dims[2])), rows(marts.mart_returns(r, i, o, *dims)),
            rows(marts.mart_product_performance(dims[0], i, o, r)),
        ))
    assert built[0] == built[1] and all(built[0])


def test_payments_are_not_moved_to_meet_their_orders(spark, rows):
    w = Warehouse(spark, SF)
    payments, orders, days = w.staged("payments"), w.keyed("fct_orders"), w.keyed("dim_date")
    built = core.fct_payments(payments, orders, days, w.inputs.raw("payments"), w.stage)
    want = payments.join(orders.select("order_id", "order_sk"), "order_id").select("payment_id", "order_sk")
    assert rows(built.select("payment_id", "order_sk")) == rows(want) and 0 < want.count() < payments.count()
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"hashpartitioning\((\w+?)#", plan) == ["payment_id"]


def test_returns_meet_items_by_one_copy_of_their_key(spark):
    w = Warehouse(spark, SF)
    plan = core.fct_returns(w.staged("returns"), w.keyed("fct_order_items"), w.keyed("dim_date"), marts.OF_ITEM)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"ReadSchema: struct<[^>]*order_item_sk", plan)


def test_written_sales_are_those_of_the_plan_without_its_look_ups(spark, rows):
    w = Warehouse(spark, SF)
    assert rows(w.table("mart_sales")) == rows(w.plan("mart_sales"))
    read = [{t for t in ("fct_order_items", "dim_customer") if any(f"/{t}/" in f for f in df.inputFiles())} for df in (w._rows("mart_sales"), w.plan("mart_sales"))]
    assert read == [set(), {"fct_order_items", "dim_customer"}]


def test_products_of_an_order_from_returns_that_met_their_items_before(spark, rows):
    orders = spark.sql("select 'o1' order_sk, timestamp_ntz'2024-01-02' order_ts, 'delivered' status union all select 'o2', timestamp_ntz'2024-01-03', 'placed' union all select 'o3', timestamp_ntz'2024-01-04', 'shipped'")
    items = spark.createDataFrame(
        [("i1", "o1", "p1", 2, 10, 20), ("i2", "o1", "p1", 1, 7, 7), ("i3", "o1", "p2", 1, None, None), ("i4", "o2", "p1", 3, 5, 15)],
        "order_item_sk string, order_sk string, product_sk string, quantity long, unit_price_cents long, line_amount_cents long",
    )
    returns = spark.createDataFrame([("i1", 1), ("i1", 1), ("i3", 1), ("i4", 2), ("other", 9)], "order_item_sk string, quantity long")
    found = refresh.order_products(orders, items, marts.with_items(returns, items), "yyyy")
    assert rows(unpacked(found).drop("order_ts", "sold_in")) == [
        ("o1", True, "p1", 3, 27, 17, 2, 1, 2, 20), ("o1", True, "p2", 1, None, None, 0, 1, 1, 0),
        ("o2", False, "p1", 0, 0, 0, 0, 0, 2, 10), ("o3", True, None, None, None, None, None, 0, None, None),
    ]
