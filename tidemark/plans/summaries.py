"""Sums kept beside the marts, for reports that read nothing else.

A summary holds one row for each group of a table's rows: how many rows there are, and of each measure the sum and how many
values went into it. All of these are additive, so summaries of parts of a table merge into the summary of the whole, and a
row that goes away is a row of weight -1. A sum without values is NULL, as it is over the rows themselves.

``Summaries`` keeps them over tables of versions (``sources.tables``). A refresh sums only the folders that one of two
versions lists alone, puts the difference on the stored groups it touches, and publishes these with the version they were
summed up to. A refresh that breaks off is done again; of two at a time, the second fails and changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import COMPRESSION
from tidemark.sources.tables import ManifestTable

ROWS = "row_count"
_GROUP = "group_id"


def whole_cents(dollars: str) -> Column:
    """A dollar column of the marts, times 100, is a whole number of cents."""
    return F.round(F.col(dollars) * 100).cast("bigint")


@dataclass(frozen=True)
class Summary:
    """``measures`` are whole numbers made of a row of ``source``, by name."""

    source: str
    keys: tuple[str, ...]
    measures: Callable[[], dict[str, Column]]


SUMMARIES = {
    "sales_by_day": Summary("mart_sales", ("date",), lambda: {"net_cents": whole_cents("net_revenue")}),
    "sales_by_month": Summary("mart_sales", ("year", "month", "region_name"), lambda: {
        "gross_cents": F.col("total_amount_cents"), "net_cents": whole_cents("net_revenue"), "returned_cents": whole_cents("returned_revenue"),
    }),
    "orders_by_status": Summary("fct_orders", ("status",), lambda: {"total_cents": F.col("total_amount_cents")}),
}


def _counted(name: str) -> str:
    return f"{name}_values"


def partial_sums(rows: DataFrame, summary: Summary, weight: Column | None = None) -> DataFrame:
    """The summary of ``rows``, each counted ``weight`` times (once)."""
    weight = F.lit(1) if weight is None else weight
    sums = [F.sum(weight).cast("bigint").alias(ROWS)]
    for name, value in summary.measures().items():
        sums += [F.sum(value * weight).cast("bigint").alias(name), F.sum(F.when(value.isNotNull(), weight).otherwise(0)).cast("bigint").alias(_counted(name))]
    return rows.groupBy(*summary.keys).agg(*sums)


def merged(parts: DataFrame, summary: Summary) -> DataFrame:
    """One summary of the stacked summaries ``parts``; groups without rows are gone."""
    names = [n for measure in summary.measures() for n in (measure, _counted(measure))]
    return parts.groupBy(*summary.keys).agg(*(F.sum(n).cast("bigint").alias(n) for n in (ROWS, *names))).where(F.col(ROWS) != 0)


def totals(stored: DataFrame, summary: Summary) -> DataFrame:
    """Keys, row count and sums, as ``groupBy`` over the rows would give them."""
    return stored.select(*summary.keys, ROWS, *(F.when(F.col(_counted(m)) > 0, F.col(m)).alias(m) for m in summary.measures()))


@dataclass(frozen=True)
class Summaries:
    """Summaries in ``root``. ``source`` gives the tables they are of."""

    spark: SparkSession
    root: str
    source: Callable[[str], ManifestTable]

    def table(self, name: str) -> ManifestTable:
        return ManifestTable(self.spark, f"{self.root}/{name}", indexed=(_GROUP,))

    def read(self, name: str) -> DataFrame:
        return totals(self.table(name).read(), SUMMARIES[name])

    def refresh(self, name: str) -> int:
        """Bring one summary up to date; returns how many of its groups changed."""
        summary, table = SUMMARIES[name], self.table(name)
        source = self.source(summary.source)
        now, before = source.current_version(), table.about() if table.exists() else {}
        if before.get("version") == now:
            return 0
        # Equal keys have equal ids; groups that share an id by chance are merely computed again together.
        group = F.xxhash64(*(F.col(f"`{k}`") for k in summary.keys))
        moved = partial_sums(source.weighted(before.get("version"), now), summary, F.col("weight"))
        sums = [c for c in moved.columns if c not in summary.keys]
        moved = self._kept(moved.where(" or ".join(f"`{c}` <> 0" for c in sums)).withColumn(_GROUP, group), name)
        groups = moved.select(_GROUP)
        stacked = moved.drop(_GROUP)
        if before:
            stacked = stacked.unionByName(table.lookup(_GROUP, groups).drop(_GROUP))
        table.replace(_GROUP, groups, merged(stacked, summary).withColumn(_GROUP, group), {"version": now}, expected=before)
        return moved.count()

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/work/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path, compression=COMPRESSION)
        return self.spark.read.schema(df.schema).parquet(path)
