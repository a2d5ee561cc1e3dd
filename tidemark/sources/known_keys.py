"""The keys that batches brought, with an index for each batch: consulted in place of the batches themselves.

A batch's distinct keys lie in a folder of their own with a Bloom index of about four bytes a key (``tables``). To find out
which keys of a new batch are known, its keys meet the indexes, and only the key files of batches whose index may have one
are opened; what is found there is compared key by key. Rows of the raw table are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import dedup
from tidemark.sources.tables import ManifestTable


@dataclass(frozen=True)
class KnownKeys:
    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    batch: str = "_batch_id"

    @property
    def table(self) -> ManifestTable:
        return ManifestTable(self.spark, self.root, keys=self.keys, partition_by=(self.batch,))

    def add(self, rows: DataFrame) -> None:
        """Note the keys of all batches in ``rows``; a batch that is known already gets them anew."""
        found = rows.select(F.col(self.batch).cast("string"), *self.keys).distinct()
        names = [r[0] for r in rows.select(F.col(self.batch).cast("string")).distinct().collect()]  # one row a batch
        if names:
            self.table.rewrite(F.col("value").isin(names), lambda number, old: found, lambda old, new: False)

    def may_be_known(self, rows: DataFrame, apart_from: str | None = None) -> DataFrame:
        """The noted keys of all batches, but ``apart_from``, whose index may have a key of ``rows``."""
        table = self.table
        if not table.exists():
            return rows.select(F.lit(None).cast("string").alias(self.batch), *self.keys).limit(0)
        return table.near(rows, None if apart_from is None else F.col("value") != apart_from)

    def duplicates(self, rows: DataFrame, batch_id: str | None = None) -> DataFrame:
        """One row: rows whose key another batch than ``batch_id`` holds. NULL equals NULL, as in ``dedup``."""
        return dedup.duplicates_vs_existing(rows, self.may_be_known(rows, batch_id), self.keys)
