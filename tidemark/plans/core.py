"""Dimensions and facts of the star schema, with plain keys (``functions.keys``): a fact finds its parents by natural keys, so
digests are neither moved nor stored. ``unpacked`` gives them their surrogate keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import calendar_columns, packed, plain_key
from tidemark.operators import scd2
from tidemark.operators.dedup import latest_by_key
from tidemark.operators.joins import as_of, with_known
from tidemark.schemas import contract

CUSTOMER_ATTRIBUTES = (
    "customer_id", "first_name", "last_name", "email", "city", "region_id", "segment", "signup_date", "updated_at",
)


def calendar(bounds: DataFrame) -> DataFrame:
    """``bounds``: one row with ``first_day`` and ``last_day``; one output row per day between them."""
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("_day"))
    return days.select(*[e.alias(name) for name, e in calendar_columns("_day").items()])


def calendar_bounds(*dated: tuple[DataFrame, str]) -> DataFrame:
    """Whole calendar years around everything in the given (frame, column) pairs, from each frame's own
    minimum and maximum."""
    spans = [
        df.agg(F.min(c).cast("date").alias("lo"), F.max(c).cast("date").alias("hi")) for df, c in dated
    ]
    both = spans[0]
    for span in spans[1:]:
        both = both.unionByName(span)
    return both.agg(
        F.trunc(F.min("lo"), "year").alias("first_day"),
        F.date_sub(F.add_months(F.trunc(F.max("hi"), "year"), 12), 1).alias("last_day"),
    )


def dim_date(bounds: DataFrame) -> DataFrame:
    return calendar(bounds).select(*contract("dim_date").fieldNames())


def dim_region(stg_regions: DataFrame) -> DataFrame:
    return stg_regions.select(
        plain_key("region_id").alias("region_sk"), "region_id", "region_name", "country"
    )


def dim_product(stg_products: DataFrame) -> DataFrame:
    return stg_products.select(
        plain_key("product_id").alias("product_sk"),
        "product_id", "name", "category", "price_cents", "active", "brand",
    )


def customer_source(stg_customers: DataFrame) -> DataFrame:
    """One row per customer, which the history needs and the snapshot file does not promise."""
    return latest_by_key(stg_customers, ["customer_id"], "updated_at").select(*CUSTOMER_ATTRIBUTES)


def customer_history(snapshots: list[tuple[DataFrame, str]]) -> DataFrame:
    """Apply (staged customers, run time) snapshots in order."""
    first, *later = snapshots
    history = scd2.open_versions(customer_source(first[0]), "customer_id")
    for staged, run_at in later:
        history = scd2.snapshot(history, customer_source(staged), "customer_id", run_at)
    return history


def dim_customer(history: DataFrame) -> DataFrame:
    return history.select(
        plain_key("customer_id", scd2.VALID_FROM).alias("customer_sk"),
        "customer_id", "first_name", "last_name", "email", "city",
        plain_key("region_id").alias("region_sk"),
        "segment", "signup_date", scd2.VALID_FROM, scd2.VALID_TO,
        F.col(scd2.VALID_TO).isNull().alias("is_current"),
    )


def _dated(facts: DataFrame, at: str, dim_date: DataFrame, key: str) -> DataFrame:
    """Date key by join, so days outside the calendar drop out."""
    days = dim_date.select(F.col("date").alias("_date"), F.col("date_sk").alias(key))
    return facts.join(days, F.col(at).cast("date") == F.col("_date")).drop("_date")


def fct_orders(stg_orders: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """``carried`` are columns of the customer's version that come behind those of the fact."""
    versions = packed(dim_customer.select("customer_sk", "customer_id", scd2.VALID_FROM, scd2.VALID_TO, *carried))
    orders = stg_orders.select(
        "order_id", "customer_id", "status", "total_amount_cents", "currency", "order_ts", "updated_at"
    )
    matched = as_of(_dated(orders, "order_ts", dim_date, "order_date_sk"), versions, "customer_id", "order_ts")
    return matched.withColumn("order_sk", plain_key("order_id")).select(*contract("fct_orders").fieldNames(), *carried)


def fct_order_items(
    stg_order_items: DataFrame, fct_orders: DataFrame, dim_product: DataFrame, raw: DataFrame, stage: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """``raw`` are the rows that were staged. Keys are made of natural ones, so of order and product only whether they are known
    is asked."""
    items = with_known(with_known(stg_order_items, "product_id", dim_product, raw, stage), "order_id", fct_orders, raw, stage)
    return items.select("*", *(plain_key(k).alias(sk) for k, sk in (("item_id", "order_item_sk"), ("order_id", "order_sk"), ("product_id", "product_sk")))).select(
        *contract("fct_order_items").fieldNames()
    )


def fct_payments(
    stg_payments: DataFrame, fct_orders: DataFrame, dim_date: DataFrame, raw: DataFrame, stage: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """``raw`` are the rows that were staged; of the order only whether it is known is asked, as for items."""
    payments = with_known(_dated(stg_payments, "event_ts", dim_date, "payment_date_sk"), "order_id", fct_orders, raw, stage)
    return payments.select("*", plain_key("payment_id").alias("payment_sk"), plain_key("order_id").alias("order_sk")).select(
        *contract("fct_payments").fieldNames()
    )


def fct_returns(stg_returns: DataFrame, fct_order_items: DataFrame, dim_date: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """``carried`` are columns of the item that come behind those of the fact."""
    items = packed(fct_order_items.select(F.col("item_id").alias("order_item_id"), *carried))  # the item's key is made of its id
    return (
        _dated(stg_returns, "returned_at", dim_date, "return_date_sk").join(items, "order_item_id")
        .select("*", plain_key("return_id").alias("return_sk"), plain_key("order_item_id").alias("order_item_sk"))
        .select(*contract("fct_returns").fieldNames(), *carried)
    )
