from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Makes the order of rows with equal keys and equal times total.
ARRIVAL_ORDER = ("_batch_id", "_source_file", "_source_row_number")


def latest_by_key(
    df: DataFrame, keys: Sequence[str], order_by: str, tiebreak: Sequence[str] = ARRIVAL_ORDER
) -> DataFrame:
    """Newest row per key.

    Spark keeps one row per key in each input partition before the exchange (``WindowGroupLimit``), so
    a key that holds a large share of all rows sends one row per map task and not its whole group.
    """
    newest_first = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in (order_by, *tiebreak)]
    )
    return df.withColumn("_rn", F.row_number().over(newest_first)).where("_rn = 1").drop("_rn")


def repeated_keys(df: DataFrame, keys: Sequence[str], count_name: str = "copies") -> DataFrame:
    """Keys held by more than one row; NULL keys count as equal."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) > 1)


def duplicates_in_batch(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows − distinct keys. Keys are first counted per key, so nothing but one row per key
    and map task is shuffled; NULL equals NULL."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates_in_batch")
    )


def duplicates_vs_existing(
    batch: DataFrame, existing: DataFrame, keys: Sequence[str], stage: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """One row: rows of ``batch`` whose key already occurs in ``existing`` (rows of other batches).

    History is reduced to the keys of the batch before it is made distinct, so what is shuffled does not
    grow with the age of the warehouse. ``stage`` writes the batch's keys and reads them back: of a
    written table Spark knows the size when it plans, and does not move history to meet a small one.
    """
    new = stage(batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    old = _where_key_in(existing.select(*keys), new, keys).distinct()
    matched = _where_key_in(new, old, keys)
    return matched.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("duplicates_vs_existing_batches")
    )


def _where_key_in(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key, NULL included, occurs among the others'."""
    return rows.alias("l").join(others.alias("r"), _all([F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]), "left_semi")


def _all(conditions):
    combined = conditions[0]
    for condition in conditions[1:]:
        combined = combined & condition
    return combined
