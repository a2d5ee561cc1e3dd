"""Run status per source, freshness, and listings of the ingestion state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import FRESHNESS_ERROR_HOURS, FRESHNESS_WARN_HOURS

# The sources shown in the run status.
REPORTED_SOURCES = ("customers", "orders", "order_items", "payments", "returns", "products")


def source_counts(raw: dict[str, DataFrame]) -> DataFrame:
    """(source_name, row_count, last_ingested_at); sources that are empty have a zero row."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count"), F.max("_ingested_at").alias("last_ingested_at"))
        .select(F.lit(name).alias("source_name"), "row_count", "last_ingested_at")
        for name, df in raw.items()
    ]
    return _union(counts)


def _union(frames: list[DataFrame]) -> DataFrame:
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame)
    return combined


def pipeline_runs(raw: dict[str, DataFrame], marks: DataFrame, quarantine: DataFrame) -> DataFrame:
    """``marks``: one row per source; ``quarantine``: rejected rows of all sources."""
    rejected = quarantine.groupBy(F.col("_source_name").alias("source_name")).agg(
        F.count(F.lit(1)).alias("quarantined_rows")
    )
    last = marks.select("source_name", F.col("watermark_value").alias("last_watermark"))
    return (
        source_counts({n: raw[n] for n in REPORTED_SOURCES if n in raw})
        .join(last, "source_name", "left").join(rejected, "source_name", "left")
        .fillna({"quarantined_rows": 0})
        .select("source_name", "row_count", "last_ingested_at", "last_watermark", "quarantined_rows")
    )


def age_hours(at: str | Column, now: str) -> Column:
    column = F.col(at) if isinstance(at, str) else at
    seconds = F.timestamp_diff("SECOND", column, F.lit(now).cast("timestamp_ntz"))
    return seconds / F.lit(3600.0)


def with_staleness(runs: DataFrame, now: str, limit_hours: int = FRESHNESS_WARN_HOURS) -> DataFrame:
    return runs.withColumn("age_hours", age_hours("last_ingested_at", now)).withColumn(
        "is_stale", F.col("age_hours") > limit_hours
    )


def freshness(counts: DataFrame, now: str) -> DataFrame:
    """pass, warn or error per source; a source without rows is an error."""
    age = F.col("age_hours")
    status = (
        F.when(age.isNull() | (age > FRESHNESS_ERROR_HOURS), "error")
        .when(age > FRESHNESS_WARN_HOURS, "warn").otherwise("pass")
    )
    return counts.withColumn("age_hours", age_hours("last_ingested_at", now)).select(
        "source_name", "last_ingested_at", "age_hours", status.alias("status")
    )


def raw_counts(raw: dict[str, DataFrame]) -> DataFrame:
    return source_counts(raw).select("source_name", "row_count")


def top_values(df: DataFrame, column: str, rows: int, count_name: str, at_least: int = 1) -> DataFrame:
    """The most frequent values, ties by value."""
    return (
        df.groupBy(column).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) >= at_least)
        .orderBy(F.col(count_name).desc(), F.col(column).asc_nulls_last()).limit(rows)
    )


def drift_coverage(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).isNotNull().alias("present")).agg(F.count(F.lit(1)).alias("rows"))
