"""Checks. Each returns its violations as rows; no rows means passed."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import row_digest


class ContractError(ValueError):
    pass


def null_counts(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULLs of many columns in one pass: (table_name, column_name, violations)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "violations").select(
        F.lit(table).alias("table_name"), "column_name", "violations"
    )


def count_violations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Any number of row-level checks over one table in one pass: (check_name, violations)."""
    counts = df.agg(*[F.count_if(condition).alias(name) for name, condition in checks.items()])
    return counts.unpivot([], [F.col(f"`{name}`") for name in checks], "check_name", "violations")


def not_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeated key combinations; a NULL in a key exempts the row."""
    present = df
    for key in keys:
        present = present.where(F.col(key).isNotNull())
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def broken_grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Like ``not_unique`` but NULLs group together, as a grain has no exemptions."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def unaccepted_values(df: DataFrame, column: str, accepted: Iterable) -> DataFrame:
    """Values outside the accepted set, with their counts. NULL passes."""
    return (
        df.where(~F.col(column).isin(*accepted))
        .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("violations"))
    )


def null_rate(df: DataFrame, column: str, limit: float) -> DataFrame:
    empty = F.count_if(F.col(column).isNull())
    rate = empty / F.nullif(F.count(F.lit(1)), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("rows_checked"), empty.alias("nulls"), (rate <= limit).alias("passed")
    )


def contract_differences(actual: T.StructType, declared: T.StructType) -> list[str]:
    """Names and types must be equal; the order of columns must not."""
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    want = {f.name: f.dataType.simpleString() for f in declared.fields}
    found = [f"missing column {c} {t}" for c, t in want.items() if c not in have]
    found += [f"undeclared column {c} {t}" for c, t in have.items() if c not in want]
    found += [
        f"column {c} is {have[c]}, declared {t}" for c, t in want.items() if c in have and have[c] != t
    ]
    return found


def enforce_contract(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Fails on the schema alone, before any data is read."""
    found = contract_differences(df.schema, declared)
    if found:
        raise ContractError("; ".join(found))
    return df.select(*declared.fieldNames())


def volume_drift(
    df: DataFrame, series: str, batch: str, preceding: int = 7, limit: float = 3.0
) -> DataFrame:
    """Rows per batch against the mean and deviation of the preceding batches of the same series. The
    window runs over one row per batch."""
    past = Window.partitionBy(series).orderBy(batch).rowsBetween(-preceding, -1)
    n = F.col("row_count")
    return (
        df.groupBy(series, batch).agg(F.count(F.lit(1)).alias("row_count"))
        .withColumns({"past_mean": F.avg("row_count").over(past), "past_stddev": F.stddev_pop("row_count").over(past)})
        .withColumn(
            "drifted",
            F.coalesce(F.abs(n - F.col("past_mean")) > F.col("past_stddev") * F.lit(limit), F.lit(False)),
        )
    )


def table_checksum(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Order-free fingerprint of a table that merges partial results: the row count, and the sum and the
    exclusive-or of parts of each row's md5."""
    digest = row_digest(*columns)
    high = F.conv(F.substring(digest, 1, 8), 16, 10).cast("decimal(20,0)")
    low = F.conv(F.substring(digest, 17, 15), 16, 10).cast("bigint")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(high).cast("string"), F.lit("0")).alias("digest_sum"),
        F.coalesce(F.bit_xor(low), F.lit(0)).alias("digest_xor"),
    )
