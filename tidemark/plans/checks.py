"""The check suite: every check as (check_name, severity, violations, action), table by table."""

from __future__ import annotations

from functools import reduce
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import days_between
from tidemark.operators import quality, scd2
from tidemark.operators.joins import distinct_keys, without_match
from tidemark.operators.ranking import exact_median
from tidemark.schemas import (
    CURRENCIES, ORDER_STATUSES, PAYMENT_METHODS, PAYMENT_STATUSES, PRICE_OUTLIER_CENTS, PRICE_OUTLIER_MEDIANS,
    QUARANTINE_LIMIT, RETURN_REASONS, REVENUE_STATUSES, SEGMENTS,
)
from tidemark.sources.store import write_partitions

# What a violated check leads to.
ACTIONS = {"error": "fail", "reject": "quarantine", "warning": "warn", "replay": "dedup"}

GRAINS = {
    "mart_sales": ("order_sk",),
    "mart_customer_retention": ("cohort_month", "order_month"),
    "mart_product_performance": ("product_sk",),
    "mart_returns": ("return_date_sk", "reason", "category", "region_name"),
    "mart_inventory": ("product_id", "warehouse_id"),
}

# The columns that must be filled, the columns whose values must not repeat, the columns whose values
# must occur in another table's column, and the columns that take listed values only.
REQUIRED = {
    "raw_customers": ("customer_id",), "raw_regions": ("region_id",),
    "raw_orders": ("order_id", "customer_id", "order_ts", "status", "total_amount_cents", "updated_at"),
    "raw_returns": ("return_id", "order_item_id", "returned_at", "reason"), "raw_products": ("product_id", "category"),
    "raw_order_items": ("item_id", "order_id"), "raw_payments": ("payment_id", "order_id"),
    "raw_inventory_levels": ("product_id", "warehouse_id", "stock_on_hand"),
    "stg_customers": ("customer_id", "region_id", "signup_date", "updated_at"),
    "stg_regions": ("region_id", "region_name", "country"),
    "stg_orders": ("order_id", "customer_id", "order_ts", "status", "total_amount_cents", "updated_at"),
    "stg_returns": ("return_id", "order_item_id", "returned_at", "quantity"),
    "stg_products": ("product_id", "category", "price_cents", "active"),
    "stg_order_items": ("item_id", "order_id", "product_id", "quantity", "unit_price_cents", "line_amount_cents"),
    "stg_payments": ("payment_id", "order_id", "amount_cents", "event_ts", "updated_at"),
    "stg_inventory_levels": ("product_id", "warehouse_id", "stock_on_hand", "reorder_point", "updated_at"),
    "dim_region": ("region_sk", "region_id", "region_name", "country"),
    "dim_product": ("product_sk", "product_id", "name", "category", "price_cents", "active"),
    "dim_date": ("date_sk", "date", "year", "month"),
    "dim_customer": (
        "customer_sk", "customer_id", "first_name", "last_name", "region_sk", "segment", "signup_date", "dbt_valid_from", "is_current",
    ),
    "fct_orders": (
        "order_sk", "order_id", "customer_sk", "order_date_sk", "status", "total_amount_cents", "order_ts", "updated_at",
    ),
    "fct_order_items": (
        "order_item_sk", "item_id", "order_sk", "product_sk", "quantity", "unit_price_cents", "line_amount_cents", "updated_at",
    ),
    "fct_payments": (
        "payment_sk", "payment_id", "order_sk", "payment_date_sk", "amount_cents", "status", "event_ts", "updated_at",
    ),
    "fct_returns": (
        "return_sk", "return_id", "order_item_sk", "return_date_sk", "reason", "quantity", "returned_at", "updated_at",
    ),
    "mart_sales": ("order_sk", "order_id", "date", "region_name", "gross_revenue", "net_revenue"),
    "mart_customer_retention": ("cohort_month", "customers", "retention_rate"),
    "mart_product_performance": ("product_sk", "product_id", "product_revenue", "units_sold", "return_rate"),
    "mart_returns": ("return_date_sk", "reason", "category", "total_returned_units", "total_returned_revenue"),
    "mart_inventory": ("product_sk", "warehouse_id", "stock_on_hand", "low_stock_flag"),
}

KEYS = {
    "raw_customers": ("customer_id",), "raw_regions": ("region_id",), "raw_products": ("product_id",),
    "stg_customers": ("customer_id",), "stg_regions": ("region_id",), "stg_orders": ("order_id",), "stg_returns": ("return_id",),
    "stg_products": ("product_id",), "stg_order_items": ("item_id",), "stg_payments": ("payment_id",),
    "dim_region": ("region_sk", "region_id"), "dim_product": ("product_sk", "product_id"), "dim_date": ("date_sk", "date"),
    "dim_customer": ("customer_sk",), "fct_orders": ("order_sk", "order_id"), "fct_order_items": ("order_item_sk", "item_id"),
    "fct_payments": ("payment_sk", "payment_id"), "fct_returns": ("return_sk", "return_id"), "mart_sales": ("order_sk",),
    "mart_product_performance": ("product_sk",),
}

REFERENCES = (
    ("stg_customers", "region_id", "stg_regions", "region_id"),
    ("dim_customer", "region_sk", "dim_region", "region_sk"),
    ("fct_orders", "customer_sk", "dim_customer", "customer_sk"),
    ("fct_orders", "order_date_sk", "dim_date", "date_sk"),
    ("fct_order_items", "order_sk", "fct_orders", "order_sk"),
    ("fct_order_items", "product_sk", "dim_product", "product_sk"),
    ("fct_payments", "order_sk", "fct_orders", "order_sk"),
    ("fct_payments", "payment_date_sk", "dim_date", "date_sk"),
    ("fct_returns", "order_item_sk", "fct_order_items", "order_item_sk"),
    ("fct_returns", "return_date_sk", "dim_date", "date_sk"),
)

ACCEPTED = (
    ("stg_customers", "segment", SEGMENTS), ("stg_orders", "status", ORDER_STATUSES), ("stg_orders", "currency", CURRENCIES),
    ("stg_returns", "reason", RETURN_REASONS), ("stg_payments", "status", PAYMENT_STATUSES), ("stg_payments", "method", PAYMENT_METHODS),
    ("dim_customer", "segment", SEGMENTS), ("dim_customer", "is_current", (True, False)),
    ("fct_orders", "status", ORDER_STATUSES), ("fct_orders", "currency", CURRENCIES),
    ("fct_payments", "status", PAYMENT_STATUSES), ("fct_payments", "method", PAYMENT_METHODS),
    ("fct_returns", "reason", RETURN_REASONS), ("mart_inventory", "low_stock_flag", (True, False)),
)


class Tables(Protocol):
    """Tables by name, and a place for an intermediate that is read more than once."""

    def __call__(self, name: str) -> DataFrame: ...

    def stage(self, df: DataFrame, name: str) -> DataFrame: ...



def _total(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")


def net_above_gross(mart_sales: DataFrame) -> DataFrame:
    return mart_sales.where(F.col("net_revenue") > F.col("gross_revenue")).select("order_sk")


def leaked_statuses(mart_sales: DataFrame) -> DataFrame:
    return mart_sales.where(~F.col("status").isin(*REVENUE_STATUSES)).select("order_sk", "status")


def future_orders(fct_orders: DataFrame, as_of: str) -> DataFrame:
    return fct_orders.where(F.col("order_ts") > F.lit(as_of).cast("timestamp_ntz")).select("order_sk", "order_ts")


def not_one_version(fct_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Orders that do not join to exactly one customer version. Versions are counted per key first, so
    the join never multiplies rows; unlike an inner join alone it also reports zero matches."""
    versions = distinct_keys(dim_customer, ["customer_sk"], dim_matches=F.count(F.lit(1)))
    return (
        fct_orders.select("order_id", "customer_sk").join(versions, "customer_sk", "left")
        .fillna({"dim_matches": 0}).where("dim_matches <> 1").select("order_id", "dim_matches")
    )


def price_outliers(items: DataFrame) -> DataFrame:
    """Free or absurdly expensive lines; they are reported and still load."""
    price = F.col("unit_price_cents")
    return items.where((price == 0) | (price > PRICE_OUTLIER_CENTS))


def price_outliers_by_median(items: DataFrame, times: int = PRICE_OUTLIER_MEDIANS) -> DataFrame:
    limit = exact_median(items, "unit_price_cents").scalar() * F.lit(times)
    price = F.col("unit_price_cents")
    return items.where((price == 0) | (price > limit))


def shared_emails(customers: DataFrame) -> DataFrame:
    return (
        customers.where(F.col("email").isNotNull()).groupBy("email")
        .agg(F.count_distinct("customer_id").alias("customers")).where("customers > 1")
    )


def late_payments(payments: DataFrame, days: int = 3) -> DataFrame:
    return payments.where(days_between("event_ts", "updated_at") >= days)


def reconcile_sales(mart_sales: DataFrame, fct_orders: DataFrame) -> DataFrame:
    """Row count and gross sum of the mart beside those of the fact it stems from."""
    fact = fct_orders.where(F.col("status").isin(*REVENUE_STATUSES))
    sides = [
        df.agg(F.count(F.lit(1)).alias("row_count"), F.sum("total_amount_cents").alias("gross_cents"))
        .select(F.lit(side).alias("side"), "row_count", "gross_cents")
        for side, df in (("fact", fact), ("mart", mart_sales))
    ]
    return sides[0].unionByName(sides[1])


def unmatched_orders(stg_orders: DataFrame, fct_orders: DataFrame) -> DataFrame:
    """Staged orders the fact lost: unknown customer, no version at that time, or no calendar day."""
    return without_match(stg_orders, "order_id", fct_orders, "order_id").select("order_id", "customer_id", "order_ts")


def quarantine_threshold(quarantine: DataFrame, limit: int = QUARANTINE_LIMIT) -> DataFrame:
    count = F.count(F.lit(1))
    return quarantine.agg(count.alias("quarantined"), (count > limit).alias("exceeded"))


def enforce_quarantine_threshold(quarantine: DataFrame, limit: int = QUARANTINE_LIMIT) -> DataFrame:
    """Fails the job instead of reporting."""
    message = F.concat(F.lit("quarantine limit exceeded: "), F.col("quarantined").cast("string"))
    return quarantine_threshold(quarantine, limit).select(
        F.when(F.col("exceeded"), F.raise_error(message)).otherwise(F.col("quarantined")).alias("quarantined")
    )


def row_checks(tables: Tables) -> list[DataFrame]:
    """not_null and accepted_values of every table, one scan per table."""
    from_table: dict[str, dict] = {t: {} for t in REQUIRED}
    for table, columns in REQUIRED.items():
        for column in columns:
            from_table[table][f"not_null:{table}.{column}"] = F.col(column).isNull()
    for table, column, accepted in ACCEPTED:
        from_table[table][f"accepted_values:{table}.{column}"] = ~F.col(column).isin(*accepted)
    return [quality.count_violations(tables(t), checks) for t, checks in from_table.items()]


def key_checks(tables: Tables) -> list[DataFrame]:
    """unique and relationships, one scan per table: the values of all key and reference columns are counted
    together, once per column and value. Keys that repeat are read off the counts; references are the counts of
    the child's column without a partner among those of the parent's. A reference without a value passes."""
    columns: dict[str, set[str]] = {t: set(keys) for t, keys in KEYS.items()}
    for child, fk, parent, pk in REFERENCES:
        columns.setdefault(child, set()).add(fk)
        columns.setdefault(parent, set()).add(pk)
    counted = [
        tables(t).select(F.explode(F.array(*(F.struct(F.lit(f"{t}.{c}").alias("col"), F.col(c).cast("string").alias("value")) for c in sorted(names)))).alias("v"))
        .where("v.value is not null").groupBy("v.col", "v.value").agg(F.count(F.lit(1)).alias("n"))
        for t, names in columns.items()
    ]
    values = tables.stage(reduce(DataFrame.unionByName, counted), "check-values")
    repeated = values.where("n > 1").groupBy("col").agg(F.count(F.lit(1)).alias("violations"))
    parent_of = F.create_map(*(F.lit(x) for c, fk, p, pk in REFERENCES for x in (f"{c}.{fk}", f"{p}.{pk}")))
    children = values.withColumn("parent", parent_of[F.col("col")]).where("parent is not null").alias("c")
    known = values.select(F.col("col").alias("parent"), "value").alias("p")
    missing = children.join(known, ["parent", "value"], "left_anti").groupBy("col").agg(F.sum("n").alias("violations"))
    spark = values.sparkSession
    return [
        spark.createDataFrame([(name,) for name in names], "col string").join(F.broadcast(found), "col", "left").select(
            F.concat(F.lit(f"{kind}:"), "col").alias("check_name"), F.coalesce("violations", F.lit(0)).alias("violations")
        )
        for kind, names, found in (
            ("unique", [f"{t}.{k}" for t, keys in KEYS.items() for k in keys], repeated),
            ("relationships", [f"{c}.{fk}" for c, fk, _, _ in REFERENCES], missing),
        )  # one row per column at most on either side
    ]


def mart_checks(tables: Tables) -> list[DataFrame]:
    grains = [_total(quality.broken_grain(tables(m), keys), f"grain:{m}") for m, keys in GRAINS.items()]
    sales = tables("mart_sales")
    business = quality.count_violations(sales, {
        "net_le_gross": F.col("net_revenue") > F.col("gross_revenue"),
        "status_leak": ~F.col("status").isin(*REVENUE_STATUSES),
    })
    return [*grains, business]


def history_checks(tables: Tables) -> list[DataFrame]:
    history = tables("snap_customer")
    return [
        _total(scd2.structure_violations(history, "customer_id"), "scd2_structure"),
        _total(scd2.duplicate_versions(history, "customer_id"), "scd2_duplicates"),
        _total(scd2.violations(history, "customer_id"), "scd2_continuity"),
        _total(not_one_version(tables("fct_orders"), tables("dim_customer")), "scd2_one_version"),
    ]


def warning_checks(tables: Tables) -> list[DataFrame]:
    return [
        _total(price_outliers(tables("fct_order_items")), "price_outliers"),
        _total(shared_emails(tables("stg_customers")), "duplicate_email"),
        _total(late_payments(tables("stg_payments")), "late_payments"),
    ]


def _graded(results: list[DataFrame], severity: str) -> DataFrame:
    union = results[0]
    for result in results[1:]:
        union = union.unionByName(result)
    return union.select(
        "check_name", F.lit(severity).alias("severity"), F.col("violations").cast("bigint").alias("violations"),
        F.when(F.col("violations") > 0, ACTIONS[severity]).otherwise("none").alias("action"),
    )


def check_results(tables: Tables) -> DataFrame:
    """All checks, with the action each outcome calls for."""
    errors = [*row_checks(tables), *key_checks(tables), *mart_checks(tables), *history_checks(tables)]
    rejects = [_total(tables("quarantine"), "rejected_rows")]
    replays = [_total(quality.not_unique(tables("raw_orders"), ["order_id"]), "replayed_orders")]
    return (
        _graded(errors, "error").unionByName(_graded(warning_checks(tables), "warning"))
        .unionByName(_graded(rejects, "reject")).unionByName(_graded(replays, "replay"))
    )


def store_failures(failures: dict[str, DataFrame], path: str, run_id: str) -> None:
    """Keep the violating rows of each check under (check, run); a repeated run replaces its own."""
    for name, rows in failures.items():
        kept = rows.select(
            F.to_json(F.struct(*rows.columns)).alias("row_json"), F.lit(name).alias("check_name"),
            F.lit(run_id).alias("run_id"),
        )
        write_partitions(kept, path, "check_name", "run_id")
