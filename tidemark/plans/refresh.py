"""Marts kept up to date by increments.

The facts are tables of versions (``sources.tables``), merged by ``plans.increments``. Each refresh asks what changed in
them since the versions that the marts were last computed from, traces the changed rows to the groups of each mart that
they belong or belonged to, computes only these groups again, and puts them in the place of the old ones:

- an order changes with its own row, its items, its payments and the returns of its items: sales by order;
- a customer version changes with its orders, a cohort with its customer versions: retention by cohort, over a stored table
  of the months of each customer version;
- a return changes with its own row, its item and its order, a group of returns lies within one day: returns by day;
- sales of an order by product are stored, and products get the difference of what its changed orders sold before and now;
  ranks are computed anew over the products. Velocity reads the stored sales of the last days alone.

Changed rows come from the partitions that two versions do not share, and the rest of a group from an index on the column it
is looked up by, so facts are read where the increment touched them and not elsewhere. A mart is published with the versions
it was computed from: a refresh that breaks off is done again from there, and one that has nothing to do changes nothing.

Changes of dimensions are not traced; they call for a rebuild, as for the facts themselves.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tidemark.functions import packed, unpacked
from tidemark.plans import increments, marts
from tidemark.session import COMPRESSION, light_driver
from tidemark.sources.tables import ManifestTable

Tables = Callable[[str], DataFrame]

#: Mart or stored intermediate: the columns that deal out its rows, and the columns it is looked up by.
_STORED = {
    "mart_sales": (("sold_in",), ("order_sk",)),
    "customer_months": (("cohort_month",), ("customer_sk", "cohort_month")),
    "mart_customer_retention": (("cohort_month",), ("cohort_month",)),
    "order_products": (("sold_in",), ("order_sk",)),
    "product_totals": ((), ("product_sk",)),
    "mart_product_performance": ((), ()),
    "mart_returns": (("returned_in",), ("return_date_sk",)),
    "mart_inventory": ((), ()),
}
#: The columns of a fact's changed rows that name groups of the marts.
_TRACED = {
    "fct_orders": ("order_sk", "customer_sk"), "fct_order_items": ("order_sk",), "fct_payments": ("order_sk",),
    "fct_returns": ("order_item_sk", "return_date_sk"),
}
_SUMS = ("units_sold", "revenue_cents", "order_count", "price_sum", "lines", "returned_units", "returned_cents")


def _all(frames: list[DataFrame]) -> DataFrame:
    return unpacked(reduce(DataFrame.union, map(packed, frames)).distinct(), frames[0].schema)


@dataclass(frozen=True)
class Marts:
    """Marts in ``root`` over the facts stored below ``facts``. ``dimension`` gives the dimensions, with keys in the form that
    the facts have them in (plain or surrogate keys), and the staged inventory.
    Rows lie in partitions of one ``period``, a pattern of date_format whose values are in the order of time."""

    spark: SparkSession
    root: str
    facts: str
    dimension: Tables
    period: str = "yyyy-MM"

    def table(self, name: str) -> ManifestTable:
        by, indexed = _STORED[name]
        return ManifestTable(self.spark, f"{self.root}/{name}", partition_by=by, indexed=indexed)

    def read(self, name: str) -> DataFrame:
        return self.table(name).read().drop("sold_in", "returned_in")

    def fact(self, name: str) -> ManifestTable:
        return increments.fact_table(self.spark, f"{self.facts}/{name}", name)

    def _changes(self, name: str, seen: dict[str, int], now: dict[str, int]) -> DataFrame | None:
        """The groups that changed rows belong to; None for all, which is so on the first refresh."""
        return self._kept(self.fact(name).changes(seen[name], now[name], _TRACED[name]), f"changed-{name}") if name in seen else None

    def _find(self, name: str, field: str, values: DataFrame | None) -> DataFrame:
        """The rows of a fact that have one of ``values``, all rows without; with packed keys, so that what follows on the same
        key needs no other exchange."""
        if values is None:
            return self.fact(name).read()
        rows, values = self.fact(name).around(field, values)
        return packed(rows).join(packed(values), field, "left_semi")

    def _as_stored(self, df: DataFrame) -> DataFrame:
        """Packed keys in the form that the facts hold them in: plain ones as they are, others as texts."""
        key = self.fact("fct_orders").read().schema["order_sk"]
        return df if key.dataType == BinaryType() else unpacked(df)

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        """Keys, or rows of the groups that are computed anew, written and read back."""
        path = f"{self.root}/work/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path, compression=COMPRESSION)
        return self.spark.read.schema(df.schema).parquet(path)

    def refresh(self) -> dict[str, int]:
        """Bring all marts up to date. Returns how many partitions of each table were written anew."""
        now = {name: self.fact(name).current_version() for name in increments.FACTS}
        # The tables are published one after the other; this one, the last, says what all of them have seen.
        last = self.table("mart_inventory")
        seen = last.about() if last.exists() else {}
        if seen == now:
            return {}
        # One table after the other, though some do not depend on each other: the driver holds the plans, threads and broadcasts of
        # all jobs that run at a time.
        with light_driver(self.spark) as let_go:
            done = self._refreshed(seen, now, let_go)
        velocity = marts.mart_inventory(self.dimension("inventory"), self.dimension("dim_product"), *self._recent())
        self._publish("mart_inventory", velocity, now)
        return done

    def _refreshed(self, seen: dict[str, int], now: dict[str, int], let_go: Callable[[], None]) -> dict[str, int]:
        if not seen:  # nothing to trace: the facts as they are stored, without copies
            orders, changed = None, dict.fromkeys(increments.FACTS)
            fct_orders, fct_items, fct_returns = (self.fact(name).read() for name in ("fct_orders", "fct_order_items", "fct_returns"))
            return self._computed(let_go, changed, orders, fct_orders, fct_items, fct_returns)
        changed = {name: self._changes(name, seen, now) for name in increments.FACTS}
        let_go()
        items_back = self._find("fct_order_items", "order_item_sk", changed["fct_returns"].select("order_item_sk"))
        orders = self._kept(_all([
            *(changed[name].select("order_sk") for name in ("fct_orders", "fct_order_items", "fct_payments")), items_back.select("order_sk")
        ]), "orders")
        fct_orders, fct_items = (self._kept(self._find(name, "order_sk", orders), name) for name in ("fct_orders", "fct_order_items"))
        fct_returns = self._kept(self._find("fct_returns", "order_item_sk", fct_items.select("order_item_sk")), "fct_returns")
        return self._computed(let_go, changed, orders, fct_orders, fct_items, fct_returns)

    def _computed(
        self, let_go: Callable[[], None], changed: dict[str, DataFrame | None], orders: DataFrame | None, fct_orders: DataFrame, fct_items: DataFrame, fct_returns: DataFrame
    ) -> dict[str, int]:
        """Each mart's groups from the rows of the facts in them; ``orders`` is None for all. Three marts want the items of the
        returns, which meet them once."""
        returned = self._kept(marts.with_items(fct_returns.select("order_item_sk", "return_date_sk", "reason", "quantity"), fct_items), "returned-items")
        jobs = [
            lambda: {"mart_sales": self._sales(orders, fct_orders, fct_items, returned)}, lambda: self._retention(changed["fct_orders"]),
            lambda: {"mart_returns": self._returns(changed["fct_returns"], returned, fct_items, fct_orders)}, lambda: self._products(orders, fct_orders, fct_items, returned),
        ]
        done: dict[str, int] = {}
        for job in jobs:
            done |= job()
            let_go()
        return done

    def _publish(self, name: str, df: DataFrame, about: dict | None = None) -> None:
        table = self.table(name)
        table.publish(table.stage(df, about))

    def _sales(self, orders: DataFrame | None, fct_orders: DataFrame, fct_items: DataFrame, fct_returns: DataFrame) -> int:
        payments = self._find("fct_payments", "order_sk", orders)
        sales = marts.mart_sales(
            fct_orders, payments, fct_returns, fct_items, *(self.dimension(d) for d in ("dim_date", "dim_customer", "dim_region"))
        )
        return self.table("mart_sales").replace("order_sk", orders, sales.withColumn("sold_in", F.date_format("date", self.period)))

    def _retention(self, changed_orders: DataFrame | None) -> dict[str, int]:
        customers = None if changed_orders is None else self._kept(changed_orders.select("customer_sk").distinct(), "customers")
        known = packed(self.dimension("dim_customer").select("customer_sk"))
        months = packed(marts.customer_months(self._find("fct_orders", "customer_sk", customers)))
        months = self._as_stored(months.join(known, "customer_sk", "left_semi"))
        stored = self.table("customer_months")
        before = stored.current_version()
        written = stored.replace("customer_sk", customers, months)
        # Also of a refresh that broke off after the months were stored: cohorts are compared with the mart's last note.
        mart = self.table("mart_customer_retention")
        seen = mart.about().get("customer_months") if mart.exists() else None
        if seen is None or customers is None:
            cohorts, grid = None, marts.retention_grid(stored.read())
        else:
            cohorts = self._kept(stored.changes(seen, columns=("cohort_month",)).select("cohort_month").distinct(), "cohorts")
            grid = marts.retention_grid(stored.lookup("cohort_month", cohorts))
        note = {"customer_months": stored.current_version()}
        return {"customer_months": written if stored.current_version() != before else 0, "mart_customer_retention": mart.replace("cohort_month", cohorts, grid, note)}

    def _returns(self, changed: DataFrame | None, of_orders: DataFrame, fct_items: DataFrame, fct_orders: DataFrame) -> int:
        if changed is None:
            return self._return_groups(None, of_orders, fct_items, fct_orders)
        days = self._kept(_all([changed.select("return_date_sk"), of_orders.select("return_date_sk")]), "days")
        fct_returns = self._kept(self._find("fct_returns", "return_date_sk", days), "returns-of-days")
        # The mart joins these to the returns, so rows of other items and orders need not be sorted out before.
        fct_items, _ = self.fact("fct_order_items").around("order_item_sk", fct_returns.select("order_item_sk"))
        orders = packed(fct_items).join(packed(fct_returns.select("order_item_sk")), "order_item_sk", "left_semi").select("order_sk")
        fct_orders, _ = self.fact("fct_orders").around("order_sk", self._kept(orders.distinct(), "orders-of-days"))
        return self._return_groups(days, fct_returns, fct_items, fct_orders)

    def _return_groups(self, days: DataFrame | None, fct_returns: DataFrame, fct_items: DataFrame, fct_orders: DataFrame) -> int:
        groups = marts.mart_returns(fct_returns, fct_items, fct_orders, *(self.dimension(d) for d in ("dim_product", "dim_customer", "dim_region", "dim_date")))
        return self.table("mart_returns").replace("return_date_sk", days, groups.withColumn("returned_in", F.date_format("date", self.period)))

    def _products(self, orders: DataFrame | None, fct_orders: DataFrame, fct_items: DataFrame, fct_returns: DataFrame) -> dict[str, int]:
        stored, totals = self.table("order_products"), self.table("product_totals")
        parts = stored.replace("order_sk", orders, self._as_stored(order_products(fct_orders, fct_items, fct_returns, self.period)))
        seen = totals.about().get("order_products") if totals.exists() else None
        # Rows that both versions have cancel out in the sums.
        moved = packed(stored.weighted(seen)).where("product_sk is not null").groupBy("product_sk").agg(
            *(F.sum(F.col(c) * F.col("weight")).alias(c) for c in _SUMS), F.sum("weight").alias("n")
        ).where(" or ".join(f"{c} <> 0" for c in (*_SUMS, "n")))
        moved = self._kept(self._as_stored(moved.drop("n")), "moved")
        note = {"order_products": stored.current_version()}
        if totals.exists():
            both = totals.lookup("product_sk", moved.select("product_sk")).select("product_sk", *_SUMS).union(moved.select("product_sk", *_SUMS))
            moved = both.groupBy("product_sk").agg(*(F.sum(c).alias(c) for c in _SUMS))
        written = totals.replace("product_sk", moved.select("product_sk"), moved.select("product_sk", *_SUMS), note)
        products = self.dimension("dim_product").select("product_sk", "product_id", "name", "category", "brand")
        sold = totals.read().where("order_count > 0").join(products, "product_sk")
        self._publish("mart_product_performance", marts.ranked_products(unpacked(sold)))
        return {"order_products": parts, "product_totals": written}

    def _recent(self) -> tuple[DataFrame, DataFrame]:
        """Items and orders as the velocity needs them, from the stored sales of the last months."""
        stored = self.table("order_products")
        periods = sorted(r.value for r in stored.parts().where("value is not null").select("value").collect())  # one row each
        latest = None
        for value in reversed(periods):  # to the last one that has a sale, nearly always the first one looked at
            latest = stored.read(where=F.col("value") == value).where("sold").agg(F.max("order_ts")).first()[0]
            if latest is not None:
                break
        first = F.date_format(F.lit(latest) - F.make_dt_interval(F.lit(marts.VELOCITY_DAYS)), self.period)
        rows = stored.read().limit(0) if latest is None else stored.read(where=F.col("value") >= first).where("sold")
        lines = rows.where("product_sk is not null").select("order_sk", "product_sk", F.col("units_sold").alias("quantity"))
        return lines, rows.select("order_sk", "order_ts", F.lit("shipped").alias("status")).distinct()


def order_products(fct_orders: DataFrame, fct_order_items: DataFrame, fct_returns: DataFrame, period: str) -> DataFrame:
    """One row per order and product, with packed keys: what was sold, if the order counts as sold, and what came back in any
    case. An order without items has one row without a product. Returns carry their item's columns (``marts.with_items``)."""
    fct_orders, fct_order_items, fct_returns = map(packed, (fct_orders, fct_order_items, fct_returns))
    items = fct_order_items.select("order_sk", "product_sk", "quantity", "line_amount_cents", "unit_price_cents")
    back = fct_returns.select("order_sk", "product_sk", F.col("quantity").alias("back"), (F.col("quantity") * F.col("unit_price_cents")).alias("back_cents"))
    # By order before they are summed, so that the sums lie where the orders meet them: there are few lines of one order and product.
    lines = items.unionByName(back, allowMissingColumns=True).repartition("order_sk").groupBy("order_sk", "product_sk").agg(
        F.sum("quantity").alias("units"), F.sum("line_amount_cents").alias("cents"), F.sum("unit_price_cents").alias("prices"),
        F.count("unit_price_cents").alias("n"), F.coalesce(F.sum("back"), F.lit(0)).alias("returned_units"),
        F.coalesce(F.sum("back_cents"), F.lit(0)).alias("returned_cents"),
    )
    is_sold = F.col("status").isin(*marts.REVENUE_STATUSES)
    orders = fct_orders.select("order_sk", "order_ts", F.coalesce(is_sold, F.lit(False)).alias("sold"), F.date_format("order_ts", period).alias("sold_in"))
    sold = {name: F.when(F.col("sold"), F.col(c)).otherwise(F.lit(0)).alias(name) for name, c in (("units_sold", "units"), ("revenue_cents", "cents"), ("price_sum", "prices"), ("lines", "n"))}
    counted = (F.col("sold") & F.col("product_sk").isNotNull()).cast("bigint").alias("order_count")
    return orders.join(lines, "order_sk", "left").select("order_sk", "order_ts", "sold_in", "sold", "product_sk", *sold.values(), counted, "returned_units", "returned_cents")
