"""Source specifications, raw metadata and table contracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Payload columns, natural keys and watermark fields of the eight sources.


@dataclass(frozen=True)
class SourceSpec:
    name: str
    shape: str
    natural_key: tuple[str, ...]
    payload: tuple[str, ...]
    watermark: str | None = None
    quarantined: bool = False

    @property
    def source_ref(self) -> str:
        return f"{self.shape}:{self.name}"

    @property
    def payload_schema(self) -> T.StructType:
        """Raw payloads are text throughout; types are decided in staging."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.payload])


SOURCES: dict[str, SourceSpec] = {
    s.name: s
    for s in (
        SourceSpec(
            "customers", "csv", ("customer_id",),
            ("customer_id", "first_name", "last_name", "email", "city", "region_id", "segment", "signup_date", "updated_at"),
        ),
        SourceSpec(
            "regions", "csv", ("region_id",),
            ("region_id", "region_name", "country"),
        ),
        SourceSpec(
            "orders", "ndjson", ("order_id",),
            ("order_id", "customer_id", "order_ts", "status", "total_amount_cents", "currency", "updated_at"),
            watermark="updated_at", quarantined=True,
        ),
        SourceSpec(
            "returns", "ndjson", ("return_id",),
            ("return_id", "order_item_id", "returned_at", "reason", "quantity", "updated_at"),
            watermark="returned_at", quarantined=True,
        ),
        SourceSpec(
            "products", "api", ("product_id",),
            ("product_id", "name", "category", "price_cents", "active", "brand"),
        ),
        SourceSpec(
            "order_items", "rdbms", ("item_id",),
            ("item_id", "order_id", "product_id", "quantity", "unit_price_cents", "updated_at"),
            watermark="updated_at",
        ),
        SourceSpec(
            "payments", "rdbms", ("payment_id",),
            ("payment_id", "order_id", "amount_cents", "status", "method", "event_ts", "updated_at"),
            watermark="updated_at",
        ),
        SourceSpec(
            "inventory_levels", "rdbms", ("product_id", "warehouse_id"),
            ("product_id", "warehouse_id", "stock_on_hand", "reorder_point", "updated_at"),
            watermark="updated_at",
        ),
    )
}

METADATA = ("_source_name", "_batch_id", "_ingested_at", "_source_file", "_source_row_number")

# Accepted values per domain.
ORDER_STATUSES = ("placed", "shipped", "delivered", "cancelled", "returned")
REVENUE_STATUSES = ("delivered", "shipped")
PAYMENT_STATUSES = ("pending", "settled", "failed", "refunded")
PAYMENT_METHODS = ("card", "paypal", "bank_transfer")
RETURN_REASONS = ("wrong_item", "damaged", "not_as_described", "better_price", "changed_mind")
SEGMENTS = ("consumer", "corporate")
CURRENCIES = ("USD",)

# Column names and types every published table must have.
_CONTRACT_DDL = {
    "dim_region": "region_sk string, region_id string, region_name string, country string",
    "dim_product": """product_sk string, product_id string, name string, category string,
        price_cents bigint, active boolean, brand string""",
    "dim_date": """date_sk bigint, date date, year smallint, quarter smallint, month smallint,
        month_name string, day smallint, day_of_week smallint, day_name string, week_of_year smallint,
        is_weekend boolean, is_holiday boolean, fiscal_year bigint, fiscal_quarter int""",
    "dim_customer": """customer_sk string, customer_id string, first_name string, last_name string,
        email string, city string, region_sk string, segment string, signup_date date,
        dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz, is_current boolean""",
    "fct_orders": """order_sk string, order_id string, customer_sk string, order_date_sk bigint,
        status string, total_amount_cents bigint, currency string, order_ts timestamp_ntz,
        updated_at timestamp_ntz""",
    "fct_order_items": """order_item_sk string, item_id string, order_sk string, product_sk string,
        quantity bigint, unit_price_cents bigint, line_amount_cents bigint, updated_at timestamp_ntz""",
    "fct_payments": """payment_sk string, payment_id string, order_sk string, payment_date_sk bigint,
        amount_cents bigint, status string, method string, event_ts timestamp_ntz,
        updated_at timestamp_ntz""",
    "fct_returns": """return_sk string, return_id string, order_item_sk string, return_date_sk bigint,
        reason string, quantity bigint, returned_at timestamp_ntz, updated_at timestamp_ntz""",
    "mart_sales": """order_sk string, order_id string, date date, year smallint, month smallint,
        quarter smallint, month_name string, region_name string, country string, status string,
        total_amount_cents bigint, currency string, gross_revenue double, settled_revenue double,
        returned_revenue double, net_revenue double""",
    "mart_customer_retention": """cohort_month date, order_month date, customers bigint,
        cohort_revenue double, retention_rate float, repeat_orders bigint,
        first_order timestamp_ntz, last_order timestamp_ntz""",
    "mart_product_performance": """product_sk string, product_id string, name string, category string,
        brand string, units_sold bigint, product_revenue double, order_count bigint,
        avg_unit_price double, returned_units bigint, returned_revenue double, return_rate float,
        revenue_rank bigint""",
    "mart_returns": """return_date_sk bigint, date date, reason string, category string,
        region_name string, total_returned_units bigint, total_returned_revenue double,
        return_count bigint""",
    "mart_inventory": """product_sk string, product_id string, name string, category string,
        brand string, warehouse_id string, stock_on_hand bigint, reorder_point bigint,
        snapshot_date timestamp_ntz, avg_daily_units_sold double, days_of_cover double,
        low_stock_flag boolean""",
}


def contract(table: str) -> T.StructType:
    return T.StructType.fromDDL(_CONTRACT_DDL[table])


CONTRACTED_TABLES = tuple(_CONTRACT_DDL)

LOOKBACK_DAYS = 7
QUARANTINE_LIMIT = 10_000
FRESHNESS_WARN_HOURS = 26
FRESHNESS_ERROR_HOURS = 50
PRICE_OUTLIER_CENTS = 1_000_000
PRICE_OUTLIER_MEDIANS = 20
