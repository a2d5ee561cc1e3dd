"""Consumer queries on the marts and the business questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import cents_to_dollars, guarded_ratio, month_start, packed, unpacked
from tidemark.operators.ranking import with_rank
from tidemark.plans.marts import Stage, customer_months, returned_items, revenue_orders, unstaged, with_product_ratios
from tidemark.plans.summaries import ROWS, whole_cents

# Reports group exact cents. Those by day, month and status read summaries (``plans.summaries``), not the rows behind them.


def daily_net_revenue(sales_by_day: DataFrame) -> DataFrame:
    """Net revenue per day, with the all-time total beside it."""
    total = sales_by_day.agg(F.sum("net_cents")).scalar()
    return sales_by_day.select("date", cents_to_dollars("net_cents").alias("net"), cents_to_dollars(total).alias("all_time_net"))


def daily_aov(sales_by_day: DataFrame) -> DataFrame:
    revenue = cents_to_dollars("net_cents")
    return sales_by_day.select("date", F.col(ROWS).alias("orders"), revenue.alias("rev"), guarded_ratio(revenue, ROWS).alias("aov"))


def cohort_grid(mart_retention: DataFrame, rows: int | None = None) -> DataFrame:
    """All cells, or the first ``rows`` of them."""
    grid = mart_retention.select("cohort_month", "order_month", "retention_rate").orderBy("cohort_month", "order_month")
    return grid if rows is None else grid.limit(rows)


def top_products(mart_products: DataFrame, rows: int = 20) -> DataFrame:
    """The ``rows`` products with the highest revenue."""
    return mart_products.select(
        "product_id", "category", "units_sold", "product_revenue", "return_rate"
    ).orderBy(F.col("product_revenue").desc_nulls_last(), "product_id").limit(rows)


def top_products_of_sums(product_totals: DataFrame, dim_product: DataFrame, rows: int = 20) -> DataFrame:
    """The same from the sums per product."""
    names = dim_product.select("product_sk", "product_id", "category")
    return top_products(with_product_ratios(product_totals.where("order_count > 0").join(names, "product_sk")), rows)


def returns_by_reason(mart_returns: DataFrame) -> DataFrame:
    return mart_returns.groupBy("reason").agg(
        F.sum("total_returned_units").alias("units"),
        cents_to_dollars(F.sum(whole_cents("total_returned_revenue"))).alias("rev"),
    ).orderBy(F.col("units").desc_nulls_last(), "reason")


def inventory_by_warehouse(mart_inventory: DataFrame) -> DataFrame:
    return mart_inventory.groupBy("warehouse_id").agg(
        F.count(F.lit(1)).alias("skus"), F.count_if("low_stock_flag").alias("low")
    )


def low_stock_items(mart_inventory: DataFrame, rows: int | None = None) -> DataFrame:
    """All items to be reordered, or the first ``rows`` of them."""
    low = mart_inventory.where("low_stock_flag").select(
        "product_id", "warehouse_id", "stock_on_hand", "reorder_point", "days_of_cover"
    ).orderBy("product_id", "warehouse_id")
    return low if rows is None else low.limit(rows)


# Business questions


def monthly_revenue_by_region(sales_by_month: DataFrame) -> DataFrame:
    return sales_by_month.select(
        "year", "month", "region_name", cents_to_dollars("gross_cents").alias("gross_revenue"),
        cents_to_dollars("net_cents").alias("net_revenue"),
    )


def monthly_aov_by_region(sales_by_month: DataFrame) -> DataFrame:
    return sales_by_month.select(
        "year", "month", "region_name", F.col(ROWS).alias("order_count"),
        guarded_ratio(cents_to_dollars("net_cents"), ROWS).alias("avg_order_value"),
    )


def orders_by_status(status_sums: DataFrame) -> DataFrame:
    """Of all orders: the sales mart holds two statuses only."""
    return status_sums.select("status", F.col(ROWS).alias("order_count"), cents_to_dollars("total_cents").alias("order_value"))


def repeat_rate(fct_orders: DataFrame) -> DataFrame:
    """Share of each cohort's customer versions with more than one revenue order."""
    members = customer_months(fct_orders).where("order_month = cohort_month")
    return members.groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(F.col("order_count") > 1).alias("repeat_customers")
    ).withColumn("repeat_purchase_rate", guarded_ratio("repeat_customers", "customers"))


def cohorts_by_person(fct_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Cohort size, retained customers and revenue by months since the first order. Counts people: all
    versions of a customer together."""
    months = (
        revenue_orders(fct_orders).withColumn("order_month", month_start("order_ts"))
        .groupBy("customer_sk", "order_month").agg(F.sum("total_amount_cents").alias("cents"))
        .join(dim_customer.select("customer_sk", "customer_id"), "customer_sk")
        .groupBy("customer_id", "order_month").agg(F.sum("cents").alias("cents"))
        .withColumn("cohort_month", F.min("order_month").over(Window.partitionBy("customer_id")))
    )
    grid = (
        months.withColumn(
            "months_since_first", F.round(F.months_between("order_month", "cohort_month")).cast("bigint")
        )
        .groupBy("cohort_month", "months_since_first")
        .agg(F.count(F.lit(1)).alias("retained_customers"), F.sum("cents").alias("cents"))
    )
    size = F.max(F.when(F.col("months_since_first") == 0, F.col("retained_customers"))).over(
        Window.partitionBy("cohort_month")
    )
    return grid.select(
        "cohort_month", "months_since_first", size.alias("cohort_size"), "retained_customers",
        cents_to_dollars("cents").alias("cohort_revenue"),
    )


def rank_movement(
    fct_order_items: DataFrame, fct_orders: DataFrame, dim_product: DataFrame, stage: Stage = unstaged
) -> DataFrame:
    """Revenue rank of each product within each month, and its change against the product's previous
    month with sales."""
    orders = packed(revenue_orders(fct_orders).select("order_sk", month_start("order_ts").alias("order_month")))
    monthly = unpacked(
        packed(fct_order_items).join(orders, "order_sk").groupBy("product_sk", "order_month")
        .agg(F.sum("line_amount_cents").alias("cents"), F.sum("quantity").alias("units_sold"))
    )
    history = Window.partitionBy("product_sk").orderBy("order_month")
    return (
        with_rank(stage(monthly, "product_months"), "cents", "revenue_rank", by=("order_month",))
        .withColumn("previous_rank", F.lag("revenue_rank").over(history))
        .join(dim_product.select("product_sk", "product_id"), "product_sk")
        .select(
            "order_month", "product_id", "units_sold", cents_to_dollars("cents").alias("product_revenue"),
            "revenue_rank", (F.col("previous_rank") - F.col("revenue_rank")).alias("rank_movement"),
        )
    )


def return_rate_by_category(
    fct_order_items: DataFrame, fct_returns: DataFrame, dim_product: DataFrame
) -> DataFrame:
    """Returned against ordered units per category, split by reason: rate and share of the reason."""
    fct_order_items, fct_returns, products = packed(fct_order_items), packed(fct_returns), packed(dim_product.select("product_sk", "category"))
    ordered = (
        fct_order_items.groupBy("product_sk").agg(F.sum("quantity").alias("units"))
        .join(products, "product_sk").groupBy("category").agg(F.sum("units").alias("ordered_units"))
    )
    items = fct_order_items.select("order_item_sk", "product_sk")
    returned = (
        fct_returns.groupBy("order_item_sk", "reason").agg(F.sum("quantity").alias("units"))
        .join(items, "order_item_sk").groupBy("product_sk", "reason").agg(F.sum("units").alias("units"))
        .join(products, "product_sk").groupBy("category", "reason").agg(F.sum("units").alias("returned_units"))
    )
    category = Window.partitionBy("category")
    return ordered.join(returned, "category").select(
        "category", "reason", "ordered_units", "returned_units",
        guarded_ratio("returned_units", "ordered_units").alias("return_rate"),
        guarded_ratio("returned_units", F.sum("returned_units").over(category)).alias("reason_share"),
    )


def return_impact(sales_by_month: DataFrame) -> DataFrame:
    """Per month: returned value against gross and net revenue."""
    monthly = sales_by_month.groupBy("year", "month").agg(
        F.sum("gross_cents").alias("gross"), F.sum("returned_cents").alias("returned")
    )
    return monthly.select(
        "year", "month", cents_to_dollars("gross").alias("gross_revenue"),
        cents_to_dollars("returned").alias("returned_value"),
        cents_to_dollars(F.col("gross") - F.col("returned")).alias("net_of_returns"),
        guarded_ratio("returned", "gross").alias("returned_share"),
    )


def returned_amounts(fct_returns: DataFrame, fct_order_items: DataFrame) -> DataFrame:
    return unpacked(returned_items(packed(fct_returns), packed(fct_order_items)).groupBy("order_sk").agg(
        F.sum("units").alias("returned_units"), F.sum("cents").alias("returned_amount_cents")
    ))
