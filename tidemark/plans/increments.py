"""Facts built by increments: what arrived since the stored fact's last change, less a lookback, merged in."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import unpacked
from tidemark.operators import merge
from tidemark.plans import core, staging
from tidemark.schemas import contract
from tidemark.sources.tables import ManifestTable

#: A table's rows lie in partitions by the time of their last change.
PARTITION = "changed_in"

Tables = Callable[[str], DataFrame]
Stage = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Fact:
    """``raw_mark`` is the raw column that staging takes for the time of the last change; ``indexed`` are the columns by
    which marts look up rows."""

    source: str
    key: str
    raw_mark: str
    indexed: tuple[str, ...]
    build: Callable[[DataFrame, DataFrame, Tables, Stage], DataFrame]


FACTS = {
    "fct_orders": Fact("orders", "order_id", "updated_at", ("order_sk", "customer_sk"), lambda rows, raw, t, stage: core.fct_orders(rows, t("dim_customer"), t("dim_date"))),
    "fct_order_items": Fact("order_items", "order_item_sk", "updated_at", ("order_sk", "order_item_sk"), lambda rows, raw, t, stage: core.fct_order_items(rows, t("fct_orders"), t("dim_product"), raw, stage)),
    "fct_payments": Fact("payments", "payment_id", "updated_at", ("order_sk",), lambda rows, raw, t, stage: core.fct_payments(rows, t("fct_orders"), t("dim_date"), raw, stage)),
    "fct_returns": Fact("returns", "return_id", "returned_at", ("order_item_sk", "return_date_sk"), lambda rows, raw, t, stage: core.fct_returns(rows, t("fct_order_items"), t("dim_date"))),
}


def full(name: str, raw: DataFrame, tables: Tables, stage: Stage) -> DataFrame:
    """The fact from all raw rows, with plain keys; ``tables`` gives them plain too. ``stage`` writes an intermediate under a
    name and returns it as read back."""
    fact = FACTS[name]
    return fact.build(staging.STAGING[fact.source](raw), raw, tables, stage)


def build_increment(spark: SparkSession, path: str, name: str, raw: DataFrame, tables: Tables, period: str = "yyyy-MM") -> int:
    """Bring the fact stored at ``path`` up to date with ``raw``; all of it is built where nothing is stored.
    Returns how many partitions were rewritten.

    The cut is the last stored change less the lookback, a literal that the raw scan can use. Older
    versions that arrive late do not replace newer ones. ``tables`` gives the dimensions and facts joined,
    ``period`` the width of the partitions.
    """
    fact, table = FACTS[name], fact_table(spark, path, name)
    cut = merge.lookback_cut(table.read()) if table.exists() else None
    rows = full(name, merge.increment_before_dedup(raw, fact.raw_mark, cut), tables, table.kept)
    return table.merge(rows.withColumn(PARTITION, F.date_format("updated_at", period)), order_by="updated_at")


def fact_table(spark: SparkSession, path: str, name: str) -> ManifestTable:
    return ManifestTable(spark, path, keys=(FACTS[name].key,), partition_by=(PARTITION,), indexed=FACTS[name].indexed)


def stored_fact(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    table = fact_table(spark, path, name)
    return unpacked(table.read()).select(*contract(name).fieldNames()) if table.exists() else None
