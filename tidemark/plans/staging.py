"""Raw text to typed, trimmed rows, one per natural key where the source replays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import blank_to_null, folded, is_truthy, tidy
from tidemark.operators.dedup import latest_by_key
from tidemark.schemas import METADATA


def instant(column: str) -> Column:
    """ISO text to a zone-less timestamp. Bad text fails the job."""
    return F.col(column).cast("timestamp_ntz")


def whole(column: str) -> Column:
    return F.col(column).cast("bigint")


def _as(expressions: dict[str, Column]) -> list[Column]:
    return [e.alias(name) for name, e in expressions.items()]


def stg_customers(raw: DataFrame) -> DataFrame:
    texts = ("first_name", "last_name", "city", "region_id", "segment")
    return raw.select(
        "customer_id",
        *_as({c: tidy(c) for c in texts}),
        blank_to_null(folded("email")).alias("email"),
        F.col("signup_date").cast("date").alias("signup_date"),
        instant("updated_at").alias("updated_at"),
        *METADATA,
    )


def stg_regions(raw: DataFrame) -> DataFrame:
    return raw.select(*_as({c: tidy(c) for c in ("region_id", "region_name", "country")}), *METADATA)


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        "product_id",
        tidy("name").alias("name"),
        folded("category").alias("category"),
        whole("price_cents").alias("price_cents"),
        is_truthy("active").alias("active"),
        blank_to_null(tidy("brand")).alias("brand"),
        *METADATA,
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    return latest_by_key(raw, ["order_id"], "updated_at").select(
        "order_id", "customer_id",
        instant("order_ts").alias("order_ts"),
        tidy("status").alias("status"),
        whole("total_amount_cents").alias("total_amount_cents"),
        tidy("currency").alias("currency"),
        instant("updated_at").alias("updated_at"),
        *METADATA,
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    quantity, price = whole("quantity"), whole("unit_price_cents")
    return latest_by_key(raw, ["item_id"], "updated_at").select(
        "item_id", "order_id", "product_id",
        quantity.alias("quantity"),
        price.alias("unit_price_cents"),
        (quantity * price).alias("line_amount_cents"),
        instant("updated_at").alias("updated_at"),
        *METADATA,
    )


def stg_payments(raw: DataFrame) -> DataFrame:
    return latest_by_key(raw, ["payment_id"], "updated_at").select(
        "payment_id", "order_id",
        whole("amount_cents").alias("amount_cents"),
        *_as({c: tidy(c) for c in ("status", "method")}),
        *_as({c: instant(c) for c in ("event_ts", "updated_at")}),
        *METADATA,
    )


def stg_returns(raw: DataFrame) -> DataFrame:
    """The return time doubles as update time; the source's own ``updated_at`` is not used."""
    return latest_by_key(raw, ["return_id"], "returned_at").select(
        "return_id", "order_item_id",
        instant("returned_at").alias("returned_at"),
        tidy("reason").alias("reason"),
        whole("quantity").alias("quantity"),
        instant("returned_at").alias("updated_at"),
        *METADATA,
    )


def stg_inventory_levels(raw: DataFrame) -> DataFrame:
    return latest_by_key(raw, ["product_id", "warehouse_id"], "updated_at").select(
        "product_id", "warehouse_id",
        *_as({c: whole(c) for c in ("stock_on_hand", "reorder_point")}),
        instant("updated_at").alias("updated_at"),
        *METADATA,
    )


STAGING: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": stg_customers, "regions": stg_regions, "products": stg_products, "orders": stg_orders,
    "order_items": stg_order_items, "payments": stg_payments, "returns": stg_returns,
    "inventory_levels": stg_inventory_levels,
}
