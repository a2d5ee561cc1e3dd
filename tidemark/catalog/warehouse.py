"""Layers over the given tables. Staging stays a view; history, dimensions, facts and marts that several
queries read are written once per application and state of the inputs, to the shared folder, and read back:
their lineage ends there."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tidemark.catalog.inputs import FIRST_SNAPSHOT, SECOND_SNAPSHOT, Inputs
from tidemark.functions import unpacked
from tidemark.plans import core, marts, staging, summaries
from tidemark.plans.publish import publish_marts
from tidemark.schemas import CONTRACTED_TABLES, contract
from tidemark.operators.quality import enforce_contract
from tidemark.session import COMPRESSION, fit_to_input, input_state, shared_dir

LAYERS = (
    ("dim_region", "dim_product", "dim_date", "snap_customer"),
    ("dim_customer",),
    ("fct_orders",),
    ("fct_order_items", "fct_payments"),
    ("fct_returns",),
    ("mart_sales", "mart_customer_retention", "mart_product_performance", "mart_returns", "mart_inventory"),
)

_CARRIED = {"fct_orders": marts.OF_CUSTOMER, "fct_returns": marts.OF_ITEM}
_PLAIN = {name for layer in LAYERS[:-1] for name in layer}

_written: set[str] = set()
_stages = itertools.count()


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.inputs = Inputs(spark, sf_dir)
        fit_to_input(spark, self.inputs.dir)
        # What is written belongs to the inputs as they are now: after new data all tables are built anew.
        digest = hashlib.md5(f"{self.inputs.dir} {input_state(spark, self.inputs.dir)}".encode()).hexdigest()[:12]
        self.root = f"{shared_dir(spark)}/warehouse-{digest}"

    def staged(self, source: str) -> DataFrame:
        return staging.STAGING[source](self.inputs.raw(source))

    def plan(self, name: str) -> DataFrame:
        """The table as a plan over the written tables it depends on."""
        if name in summaries.SUMMARIES:
            summary = summaries.SUMMARIES[name]
            return summaries.partial_sums(self.table(summary.source), summary)
        return self._contracted(name, getattr(self, f"_{name}")().drop(*_CARRIED.get(name, ())))

    @staticmethod
    def _contracted(name: str, keyed: DataFrame) -> DataFrame:
        return enforce_contract(unpacked(keyed), contract(name)) if name in CONTRACTED_TABLES else keyed

    def table(self, name: str) -> DataFrame:
        """The written table; written now if this application has not done so."""
        return self._contracted(name, self.keyed(name))

    def keyed(self, name: str) -> DataFrame:
        """The same with keys as they are stored: dimensions and facts have plain ones, marts surrogate keys."""
        return self.carrying(name).drop(*_CARRIED.get(name, ()))

    def carrying(self, name: str) -> DataFrame:
        """The same with the parents' columns that facts carry for the marts: all are built from one state of the inputs."""
        path = f"{self.root}/{name}"
        if path not in _written:
            rows = self._rows(name)
            self._contracted(name, rows.drop(*_CARRIED.get(name, ())))  # fails where the contract is broken
            rows.write.mode("overwrite").parquet(path, compression=COMPRESSION)
            _written.add(path)
        return self.spark.read.parquet(path)

    def _rows(self, name: str) -> DataFrame:
        """What is written: as ``plan`` has it, with plain keys in dimensions and facts, and sales from the columns that facts carry."""
        if name == "mart_sales":
            return self._contracted(name, self._mart_sales(self.carrying))
        return getattr(self, f"_{name}")() if name in _PLAIN else self.plan(name)

    def summary(self, name: str) -> DataFrame:
        """A summary of a written table, written beside it."""
        return summaries.totals(self.table(name), summaries.SUMMARIES[name])

    def build(self) -> None:
        """Write all tables. Those of one layer do not depend on each other, so their jobs run side by
        side and fill the gaps that small stages leave."""
        for layer in LAYERS:
            with ThreadPoolExecutor(len(layer)) as pool:
                list(pool.map(self.table, layer))
        with ThreadPoolExecutor(len(summaries.SUMMARIES)) as pool:
            list(pool.map(self.table, summaries.SUMMARIES))

    def publish(self, folder: str, results: Callable[[], DataFrame]) -> list[str]:
        """Publish the built marts in ``folder`` if the checks let them pass; returns those that do not."""
        return publish_marts(self.spark, folder, self.table, LAYERS[-1], results)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write an intermediate to a folder of its own and read it back."""
        path = f"{self.root}/staged/{name}-{next(_stages)}"
        df.write.parquet(path, compression=COMPRESSION)
        return self.spark.read.parquet(path)

    # History and dimensions

    def _snap_customer(self) -> DataFrame:
        second = staging.stg_customers(self.inputs.customers_second())
        return core.customer_history([(self.staged("customers"), FIRST_SNAPSHOT), (second, SECOND_SNAPSHOT)])

    def _dim_customer(self) -> DataFrame:
        return core.dim_customer(self.keyed("snap_customer"))

    def _dim_region(self) -> DataFrame:
        return core.dim_region(self.staged("regions"))

    def _dim_product(self) -> DataFrame:
        return core.dim_product(self.staged("products"))

    def calendar_bounds(self) -> DataFrame:
        return core.calendar_bounds(
            (self.inputs.table("orders"), "o_orderdate"), (self.inputs.table("lineitem"), "l_shipdate")
        )

    def _dim_date(self) -> DataFrame:
        return core.dim_date(self.calendar_bounds())

    # Facts

    def _fct_orders(self) -> DataFrame:
        return core.fct_orders(self.staged("orders"), self.keyed("dim_customer"), self.keyed("dim_date"), _CARRIED["fct_orders"])

    def _fct_order_items(self) -> DataFrame:
        raw = self.inputs.raw("order_items")
        return core.fct_order_items(self.staged("order_items"), self.keyed("fct_orders"), self.keyed("dim_product"), raw, self.stage)

    def _fct_payments(self) -> DataFrame:
        raw = self.inputs.raw("payments")
        return core.fct_payments(self.staged("payments"), self.keyed("fct_orders"), self.keyed("dim_date"), raw, self.stage)

    def _fct_returns(self) -> DataFrame:
        return core.fct_returns(self.staged("returns"), self.keyed("fct_order_items"), self.keyed("dim_date"), _CARRIED["fct_returns"])

    # Marts

    def _mart_sales(self, t: Callable[[str], DataFrame] | None = None) -> DataFrame:
        t = t or self.keyed  # a plan over all its tables, each scanned once
        return marts.mart_sales(
            t("fct_orders"), t("fct_payments"), t("fct_returns"), t("fct_order_items"), t("dim_date"),
            t("dim_customer"), t("dim_region"),
        )

    def _mart_customer_retention(self) -> DataFrame:
        return marts.mart_customer_retention(self.keyed("fct_orders"), self.keyed("dim_customer"))

    def _mart_product_performance(self) -> DataFrame:
        t = self.carrying
        return marts.mart_product_performance(
            t("dim_product"), t("fct_order_items"), t("fct_orders"), t("fct_returns"), self.stage
        )

    def _mart_returns(self) -> DataFrame:
        t = self.carrying
        return marts.mart_returns(
            t("fct_returns"), t("fct_order_items"), t("fct_orders"), t("dim_product"), t("dim_customer"),
            t("dim_region"), t("dim_date"),
        )

    def _mart_inventory(self) -> DataFrame:
        t = self.carrying
        return marts.mart_inventory(
            self.staged("inventory_levels"), t("dim_product"), t("fct_order_items"), t("fct_orders"), self.stage
        )
