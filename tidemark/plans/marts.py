"""Intermediate views and marts over materialised facts and dimensions.

Surrogate keys, which are text, go through exchanges packed into bytes: marts and views pack what they read and unpack what
they return, and the steps between take either form.

Two rules shape these plans: children are aggregated to the parent's key before they are joined, and
dimension attributes are joined after the aggregation that shrinks the fact, not before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import cents_to_dollars, guarded_ratio, month_start, packed, unpacked, whole_ratio
from tidemark.operators.ranking import with_rank
from tidemark.schemas import REVENUE_STATUSES, contract

VELOCITY_DAYS = 30

# Writes an intermediate under a name and returns it as read back, ending its lineage.
Stage = Callable[[DataFrame, str], DataFrame]


def unstaged(df: DataFrame, name: str) -> DataFrame:
    return df


def revenue_orders(fct_orders: DataFrame) -> DataFrame:
    return fct_orders.where(F.col("status").isin(*REVENUE_STATUSES))


# Intermediate views


def int_customer_orders(dim_customer: DataFrame, fct_orders: DataFrame) -> DataFrame:
    customers = dim_customer.select(
        "customer_sk", "customer_id", "first_name", "last_name", "email", "city", "region_sk", "segment",
        "signup_date",
    )
    orders = packed(fct_orders.withColumnRenamed("updated_at", "order_updated_at"))
    return unpacked(orders.join(packed(customers), "customer_sk")).select(
        *customers.columns, "order_sk", "order_id", "order_ts", "order_date_sk", "status",
        "total_amount_cents", "currency", "order_updated_at",
    )


def payment_totals(fct_payments: DataFrame) -> DataFrame:
    """One row per order that has payments."""

    def amount_when(status: str):
        return F.sum(F.when(F.col("status") == status, F.col("amount_cents")).otherwise(0))

    return fct_payments.groupBy("order_sk").agg(
        F.sum("amount_cents").alias("total_paid_cents"),
        amount_when("settled").alias("settled_cents"),
        amount_when("refunded").alias("refunded_cents"),
        F.max(F.when(F.col("status") == "settled", F.col("event_ts"))).alias("last_settled_at"),
        F.bool_or(F.col("status") == "pending").alias("has_pending"),
        F.bool_or(F.col("status") == "failed").alias("has_failed"),
    )


def int_payment_status(fct_orders: DataFrame, fct_payments: DataFrame) -> DataFrame:
    """Orders without payments keep NULL totals but zero conditional sums."""
    totals = payment_totals(packed(fct_payments))
    orders = packed(fct_orders.select("order_sk", "order_id")).join(totals, "order_sk", "left")
    return unpacked(orders).fillna({"settled_cents": 0, "refunded_cents": 0})


def int_product_sales(dim_product: DataFrame, fct_order_items: DataFrame, fct_orders: DataFrame) -> DataFrame:
    products = dim_product.select(
        "product_sk", "product_id", F.col("name").alias("product_name"), "category", "brand", "price_cents"
    )
    orders = fct_orders.select("order_sk", "order_ts", "order_date_sk", "customer_sk")
    items = fct_order_items.drop("item_id", "updated_at")
    return unpacked(packed(items).join(packed(orders), "order_sk").join(packed(products), "product_sk")).select(
        *products.columns, "order_item_sk", "order_sk", "quantity", "unit_price_cents", "line_amount_cents",
        "order_ts", "order_date_sk", "customer_sk",
    )


def int_return_metrics(fct_order_items: DataFrame, fct_returns: DataFrame) -> DataFrame:
    """Every item's unit price is constant, so the returned amount is its returned quantity times price
    and returns can be aggregated before they meet the items."""
    returned = packed(fct_returns).groupBy("order_item_sk").agg(
        F.sum("quantity").alias("returned_quantity"),
        F.max("returned_at").alias("last_returned_at"),
        F.array_join(F.array_sort(F.collect_set("reason")), ", ").alias("return_reasons"),
    )
    return unpacked(packed(fct_order_items).join(returned, "order_item_sk", "left")).select(
        "order_item_sk", "order_sk", "product_sk", F.col("quantity").alias("ordered_quantity"),
        "unit_price_cents", "line_amount_cents", "returned_quantity",
        (F.col("returned_quantity") * F.col("unit_price_cents")).alias("returned_amount_cents"),
        "last_returned_at", "return_reasons",
    )


#: Columns of the item that a stored fct_returns may carry, and of the customer's version that a stored fct_orders may; then
#: marts do not look them up.
OF_ITEM = ("order_sk", "product_sk", "unit_price_cents")
OF_CUSTOMER = ("region_sk",)


def _carries(df: DataFrame, columns: tuple[str, ...]) -> bool:
    return set(columns) <= set(df.columns)


def with_items(fct_returns: DataFrame, fct_order_items: DataFrame) -> DataFrame:
    """Returns that carry their item's columns, with packed keys."""
    return packed(fct_returns.drop(*OF_ITEM)).join(packed(fct_order_items.select("order_item_sk", *OF_ITEM)), "order_item_sk")


def returned_items(fct_returns: DataFrame, fct_order_items: DataFrame) -> DataFrame:
    """(order_item_sk, order_sk, product_sk, units, cents), one row per returned item, or per return where returns carry the
    item's columns: for sums."""
    if _carries(fct_returns, OF_ITEM):
        return fct_returns.select("order_item_sk", "order_sk", "product_sk", F.col("quantity").alias("units"), (F.col("quantity") * F.col("unit_price_cents")).alias("cents"))
    units = fct_returns.groupBy("order_item_sk").agg(F.sum("quantity").alias("units"))
    items = fct_order_items.select("order_item_sk", "order_sk", "product_sk", "unit_price_cents")
    return units.join(items, "order_item_sk").withColumn("cents", F.col("units") * F.col("unit_price_cents"))


def returned_by_order(fct_returns: DataFrame, fct_order_items: DataFrame) -> DataFrame:
    return returned_items(fct_returns, fct_order_items).groupBy("order_sk").agg(
        F.sum("cents").alias("returned_amount_cents")
    )


# Marts


def mart_sales(
    fct_orders: DataFrame, fct_payments: DataFrame, fct_returns: DataFrame, fct_order_items: DataFrame,
    dim_date: DataFrame, dim_customer: DataFrame, dim_region: DataFrame,
) -> DataFrame:
    """One row per delivered or shipped order. Both children arrive as one row per order, so the fact is
    exchanged once on its key; the small dimensions follow."""
    fct_orders, fct_payments, fct_returns, fct_order_items, dim_customer, dim_region = map(
        packed, (fct_orders, fct_payments, fct_returns, fct_order_items, dim_customer, dim_region)
    )
    settled = fct_payments.where("status = 'settled'").groupBy("order_sk").agg(
        F.sum("amount_cents").alias("settled_cents")
    )
    returned = returned_by_order(fct_returns, fct_order_items)
    orders = (
        revenue_orders(fct_orders).join(settled, "order_sk", "left").join(returned, "order_sk", "left")
        .fillna({"settled_cents": 0, "returned_amount_cents": 0})
    )
    days = dim_date.select(F.col("date_sk").alias("order_date_sk"), "date", "year", "month", "quarter", "month_name")
    gross, back = F.col("total_amount_cents"), F.col("returned_amount_cents")
    sold = (
        _of_region(orders.join(days, "order_date_sk"), dim_customer)
        .join(dim_region.select("region_sk", "region_name", "country"), "region_sk")
    )
    return (
        unpacked(sold)
        .withColumns({
            "gross_revenue": cents_to_dollars(gross),
            "settled_revenue": cents_to_dollars("settled_cents"),
            "returned_revenue": cents_to_dollars(back),
            "net_revenue": cents_to_dollars(gross - back),
        })
        .select(*contract("mart_sales").fieldNames())
    )


def _of_region(orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return orders if _carries(orders, OF_CUSTOMER) else orders.join(dim_customer.select("customer_sk", *OF_CUSTOMER), "customer_sk")


def customer_months(fct_orders: DataFrame) -> DataFrame:
    """Revenue orders per customer version and month, with the version's cohort and order count.

    The per-version window runs over its months, never over its orders. Keys come back in the form they have in ``fct_orders``.
    """
    monthly = (
        revenue_orders(packed(fct_orders)).withColumn("order_month", month_start("order_ts"))
        .groupBy("customer_sk", "order_month")
        .agg(
            F.count(F.lit(1)).alias("orders"), F.sum("total_amount_cents").alias("cents"),
            F.min("order_ts").alias("first_ts"), F.max("order_ts").alias("last_ts"),
        )
    )
    version = Window.partitionBy("customer_sk")
    return unpacked(monthly.withColumns({
        "cohort_month": F.min("order_month").over(version),
        "order_count": F.sum("orders").over(version),
        "first_order": F.min("first_ts").over(version),
        "last_order": F.max("last_ts").over(version),
    }), fct_orders.schema)


def mart_customer_retention(fct_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """The unit of "customer" is the customer version. Repeat metrics belong to the cohort and repeat on
    each of its months; they are summed on the cohort's own month, where every member has one row."""
    return retention_grid(customer_months(fct_orders).join(dim_customer.select("customer_sk"), "customer_sk", "left_semi"))


def retention_grid(months: DataFrame) -> DataFrame:
    """Cohorts by month, from the months of each customer version."""
    repeat_member = (F.col("order_month") == F.col("cohort_month")) & (F.col("order_count") > 1)
    grid = months.groupBy("cohort_month", "order_month").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("cents").alias("cents"),
        F.sum(F.when(repeat_member, F.col("order_count"))).alias("repeats"),
        F.min(F.when(repeat_member, F.col("first_order"))).alias("first_repeat"),
        F.max(F.when(repeat_member, F.col("last_order"))).alias("last_repeat"),
    )
    cohort = Window.partitionBy("cohort_month")
    return grid.select(
        "cohort_month", "order_month", "customers",
        cents_to_dollars("cents").alias("cohort_revenue"),
        (F.col("customers").cast("double") / F.max("customers").over(cohort)).cast("float").alias("retention_rate"),
        F.coalesce(F.max("repeats").over(cohort), F.lit(0)).cast("bigint").alias("repeat_orders"),
        F.min("first_repeat").over(cohort).alias("first_order"),
        F.max("last_repeat").over(cohort).alias("last_order"),
    )


def product_totals(fct_order_items: DataFrame, fct_orders: DataFrame) -> DataFrame:
    """Sales per product. Lines are first reduced to one row per product and order, which also makes the
    distinct order count a plain count and leaves nothing of a best-seller's lines to shuffle whole."""
    sold = revenue_orders(fct_orders).select("order_sk")
    per_order = fct_order_items.join(sold, "order_sk").groupBy("product_sk", "order_sk").agg(
        F.sum("quantity").alias("units"), F.sum("line_amount_cents").alias("cents"),
        F.sum("unit_price_cents").alias("price_sum"), F.count("unit_price_cents").alias("lines"),
    )
    return per_order.groupBy("product_sk").agg(
        F.sum("units").alias("units_sold"), F.sum("cents").alias("revenue_cents"),
        F.count(F.lit(1)).alias("order_count"),
        F.sum("price_sum").alias("price_sum"), F.sum("lines").alias("lines"),
    )


def returned_by_product(fct_returns: DataFrame, fct_order_items: DataFrame) -> DataFrame:
    return returned_items(fct_returns, fct_order_items).groupBy("product_sk").agg(
        F.sum("units").alias("returned_units"), F.sum("cents").alias("returned_cents")
    )


def mart_product_performance(
    dim_product: DataFrame, fct_order_items: DataFrame, fct_orders: DataFrame, fct_returns: DataFrame,
    stage: Stage = unstaged,
) -> DataFrame:
    """One row per product sold. The returns side is not filtered by order status. ``stage`` may write
    the totals per product, which the ranking uses twice."""
    dim_product, fct_order_items, fct_orders, fct_returns = map(packed, (dim_product, fct_order_items, fct_orders, fct_returns))
    totals = (
        product_totals(fct_order_items, fct_orders)
        .join(returned_by_product(fct_returns, fct_order_items), "product_sk", "left")
        .fillna({"returned_units": 0, "returned_cents": 0})
        .join(dim_product.select("product_sk", "product_id", "name", "category", "brand"), "product_sk")
    )
    return ranked_products(stage(unpacked(totals), "product_totals"))


def ranked_products(totals: DataFrame) -> DataFrame:
    """The mart from the sums of each product."""
    return with_product_ratios(with_rank(totals, "revenue_cents", "revenue_rank")).select(
        "product_sk", "product_id", "name", "category", "brand", "units_sold", "product_revenue", "order_count",
        (guarded_ratio("price_sum", "lines") / F.lit(100.0)).alias("avg_unit_price"),
        "returned_units",
        cents_to_dollars("returned_cents").alias("returned_revenue"),
        "return_rate",
        "revenue_rank",
    )


def with_product_ratios(totals: DataFrame) -> DataFrame:
    rate = F.when(F.col("units_sold") > 0, F.col("returned_units").cast("double") / F.col("units_sold")).otherwise(0.0)
    return totals.withColumns({"product_revenue": cents_to_dollars("revenue_cents"), "return_rate": rate.cast("float")})


def mart_returns(
    fct_returns: DataFrame, fct_order_items: DataFrame, fct_orders: DataFrame, dim_product: DataFrame,
    dim_customer: DataFrame, dim_region: DataFrame, dim_date: DataFrame,
) -> DataFrame:
    fct_returns, fct_order_items, fct_orders, dim_product, dim_customer, dim_region = map(
        packed, (fct_returns, fct_order_items, fct_orders, dim_product, dim_customer, dim_region)
    )
    returned = ("return_date_sk", "reason", "quantity")
    if _carries(fct_returns, OF_ITEM):
        items = fct_returns.select(*returned, *OF_ITEM)
    else:
        items = fct_returns.select("order_item_sk", *returned).join(fct_order_items.select("order_item_sk", *OF_ITEM), "order_item_sk")
    customer = OF_CUSTOMER if _carries(fct_orders, OF_CUSTOMER) else ("customer_sk",)
    lines = items.join(fct_orders.select("order_sk", *customer), "order_sk").join(dim_product.select("product_sk", "category"), "product_sk")
    lines = (
        _of_region(lines, dim_customer)
        .join(dim_region.select("region_sk", "region_name"), "region_sk")
    )
    totals = lines.groupBy("return_date_sk", "reason", "category", "region_name").agg(
        F.sum("quantity").alias("total_returned_units"),
        F.sum(F.col("quantity") * F.col("unit_price_cents")).alias("cents"),
        F.count(F.lit(1)).alias("return_count"),
    )
    days = dim_date.select(F.col("date_sk").alias("return_date_sk"), "date")
    return totals.join(days, "return_date_sk").select(
        "return_date_sk", "date", "reason", "category", "region_name", "total_returned_units",
        cents_to_dollars("cents").alias("total_returned_revenue"), "return_count",
    )


def trailing_orders(fct_orders: DataFrame, days: int = VELOCITY_DAYS) -> DataFrame:
    """Revenue orders of the last days before the newest one."""
    sold = revenue_orders(fct_orders)
    start = sold.agg(F.max("order_ts") - F.make_dt_interval(F.lit(days))).scalar()
    return sold.where(F.col("order_ts") >= start)


def mart_inventory(
    stg_inventory_levels: DataFrame, dim_product: DataFrame, fct_order_items: DataFrame, fct_orders: DataFrame, stage: Stage = unstaged
) -> DataFrame:
    """``stage`` may write the orders of the last days, so that Spark knows how few they are and leaves the items in place."""
    recent = stage(packed(trailing_orders(fct_orders).select("order_sk")), "recent_orders")
    velocity = (
        packed(fct_order_items).join(recent, "order_sk", "left_semi").groupBy("product_sk")
        .agg((F.sum("quantity") / F.lit(float(VELOCITY_DAYS))).alias("avg_daily_units_sold"))
    )
    products = (
        packed(dim_product.select("product_sk", "product_id", "name", "category", "brand"))
        .join(velocity, "product_sk", "left").fillna({"avg_daily_units_sold": 0.0})
    )
    stock, reorder = F.col("stock_on_hand"), F.col("reorder_point")
    return (
        unpacked(stg_inventory_levels.join(products, "product_id"))
        .withColumns({
            "snapshot_date": F.col("updated_at"),
            "days_of_cover": whole_ratio(stock, "avg_daily_units_sold"),
            "low_stock_flag": F.coalesce(stock <= reorder, F.lit(False)),
        })
        .select(*contract("mart_inventory").fieldNames())
    )
