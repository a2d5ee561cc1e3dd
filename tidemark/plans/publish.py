"""Publishing the marts: all of them after all checks, or none."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.tables import ManifestTable

FAILED = "action = 'fail'"


def publish_marts(
    spark: SparkSession, root: str, tables: Callable[[str], DataFrame], marts: Sequence[str], results: Callable[[], DataFrame]
) -> list[str]:
    """Write a new version of each mart, run the checks, and publish the versions if no check calls for a
    stop; a mart that has not changed shares the data of its published version. ``results`` gives (check_name, ..., action), one row per check. Returns the checks that stopped it;
    then readers keep the versions published before."""
    staged = {mart: ManifestTable(spark, f"{root}/{mart}").stage(tables(mart)) for mart in marts}
    stopped = sorted(row.check_name for row in results().where(FAILED).select("check_name").collect())
    if not stopped:
        for mart, version in staged.items():
            ManifestTable(spark, f"{root}/{mart}").publish(version)
    return stopped
