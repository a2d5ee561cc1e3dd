"""Type 2 history in open and closed partitions.

Open versions lie in one partition, those that a snapshot closes in a partition of that snapshot's own, which no later one
opens or writes. A snapshot so costs what the open versions cost, however long the history grows, and one that changes
nothing leaves the version as it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import scd2
from tidemark.sources.tables import ManifestTable

_KEPT_IN, _OPEN = "kept_in", "open"
_IS_OPEN = f"value = '{_OPEN}'"


def _rows_of(parts: DataFrame) -> dict[str, int]:
    return {r["value"]: r["n"] for r in parts.groupBy("value").agg(F.sum("rows").alias("n")).collect()}  # one row per partition


@dataclass(frozen=True)
class VersionHistory:
    spark: SparkSession
    root: str
    key: str
    updated_at: str = "updated_at"

    @property
    def table(self) -> ManifestTable:
        return ManifestTable(self.spark, self.root, partition_by=(_KEPT_IN,))

    def read(self, version: int | None = None) -> DataFrame:
        """All versions, as they were after a commit of the table or are now."""
        return self.table.read(version).drop(_KEPT_IN)

    def current(self) -> DataFrame:
        """The open versions; closed ones are not opened."""
        return self.table.read(where=_IS_OPEN).drop(_KEPT_IN)

    def snapshot(self, source: DataFrame, run_at: str, close_missing: bool = True) -> int | None:
        """Apply one source snapshot (one row per key). Returns the new version's number, None if nothing changed.

        A key that was closed and comes back opens a new version, as it does in ``scd2.snapshot``."""

        def build(number: int, opened: DataFrame | None) -> DataFrame:
            if opened is None:
                after = scd2.open_versions(source, self.key, self.updated_at)
            else:
                after = scd2.snapshot(opened.drop(_KEPT_IN), source, self.key, run_at, self.updated_at, close_missing)
            closed_now = F.lit(f"closed {number:012d}")
            return after.withColumn(_KEPT_IN, F.when(F.col(scd2.VALID_TO).isNull(), _OPEN).otherwise(closed_now))

        # Whatever a snapshot changes closes a version or adds one.
        return self.table.rewrite(F.expr(_IS_OPEN), build, lambda old, new: _rows_of(old) == _rows_of(new))
