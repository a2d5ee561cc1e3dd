"""Drift of distributions between batches, from sketches kept for each batch.

A batch leaves a quantile sketch (KLL) of each numeric column and the counts of each value of its category columns. Sketches
and counts merge, so a batch is compared with all rows of the batches before it without these being read again. Drift of a
column is the largest difference between the shares of rows up to a value, of a category the largest difference between
the shares of rows with a value, in the batch and before it. A column without values on either side has no drift (NULL).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Size of a sketch: shares are off by half a percent at most, nearly always.
SKETCH_SIZE = 800
SHARE_ERROR = 0.01
#: Steps in which shares are compared; a distance is off by one of them and twice the sketches' error at most.
STEPS = 100
#: Batches that a batch is compared with, and the difference that is reported.
BEFORE = 28
REPORTED = 0.25
PROBABILITIES = tuple(k / 20 for k in range(1, 20))


def batch_sketches(rows: DataFrame, batch: str, columns: Sequence[str]) -> DataFrame:
    """(batch, column, n, sketch): one row for each batch and column of whole numbers, from one pass. NULLs are not counted;
    a column without values has no sketch."""
    sums = [e for c in columns for e in (F.count(c).alias(f"n_{c}"), F.kll_sketch_agg_bigint(F.col(c).cast("bigint"), F.lit(SKETCH_SIZE)).alias(f"s_{c}"))]
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("n"), F.when(F.col(f"n_{c}") > 0, F.col(f"s_{c}")).alias("sketch")) for c in columns)))
    return rows.groupBy(F.col(batch).alias("batch")).agg(*sums).select("batch", each.alias("e")).select("batch", "e.*")


def batch_counts(rows: DataFrame, batch: str, columns: Sequence[str]) -> DataFrame:
    """(batch, column, value, n): rows of each value; for columns of few values. NULL is a value of its own."""
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns)))
    return rows.select(F.col(batch).alias("batch"), each.alias("e")).groupBy("batch", "e.column", "e.value").agg(F.count(F.lit(1)).alias("n"))


def _followed_by(stored: DataFrame, before: int) -> DataFrame:
    """Each row once for each of the ``before`` batches after its own, whose number is ``for``."""
    numbers = stored.select("batch").distinct().withColumn("number", F.row_number().over(Window.orderBy("batch")))  # one row per batch
    reach = F.explode(F.sequence(F.col("number") + 1, F.col("number") + before))
    return stored.join(numbers, "batch").withColumn("for", reach)


def _numbered(stored: DataFrame) -> DataFrame:
    return stored.join(stored.select("batch").distinct().withColumn("for", F.row_number().over(Window.orderBy("batch"))), "batch")


def quantiles(sketches: DataFrame, probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """(batch, column, n, probability, value)."""
    found = F.kll_sketch_get_quantile_bigint("sketch", F.array(*map(F.lit, probabilities)))
    pairs = F.explode(F.zip_with(F.array(*map(F.lit, probabilities)), found, lambda p, v: F.struct(p.alias("probability"), v.alias("value"))))
    return sketches.where("n > 0").select("batch", "column", "n", pairs.alias("q")).select("batch", "column", "n", "q.*")


def _share(quantiles: str, value: Column) -> Column:
    """The share of rows up to ``value``, from the values at ``STEPS`` equal steps."""
    return F.size(F.filter(quantiles, lambda q: q <= value)) / STEPS


def numeric_drift(sketches: DataFrame, before: int = BEFORE, reported: float = REPORTED) -> DataFrame:
    """(batch, column, n, n_before, distance, drifted) for each batch with others before it, of stored sketches."""
    valued = sketches.where("n > 0")
    history = _followed_by(valued, before).groupBy("for", "column").agg(
        F.sum("n").alias("n_before"), F.kll_merge_agg_bigint("sketch", F.lit(SKETCH_SIZE)).alias("earlier")
    )
    grid = F.array(*(F.lit(k / STEPS) for k in range(1, STEPS + 1)))
    both = _numbered(valued).join(history, ["for", "column"]).withColumns(
        {"now": F.kll_sketch_get_quantile_bigint("sketch", grid), "then": F.kll_sketch_get_quantile_bigint("earlier", grid)}
    )
    apart = F.transform(F.array_union("now", "then"), lambda value: F.abs(_share("now", value) - _share("then", value)))
    distance = F.array_max(apart)
    return both.select("batch", "column", "n", "n_before", distance.alias("distance"), (distance > reported).alias("drifted"))


def category_drift(counts: DataFrame, before: int = BEFORE, reported: float = REPORTED) -> DataFrame:
    """(batch, column, n, n_before, distance, drifted) for each batch with others before it, of stored counts."""
    earlier = _followed_by(counts, before).groupBy("for", "column", "value").agg(F.lit(0).cast("bigint").alias("n"), F.sum("n").alias("n_before"))
    now = _numbered(counts).select("for", "column", "value", "n", F.lit(0).cast("bigint").alias("n_before"))
    names = _numbered(counts).select("for", "batch").distinct()
    both = now.unionByName(earlier).groupBy("for", "column", "value").agg(F.sum("n").alias("n"), F.sum("n_before").alias("n_before"))
    whole = Window.partitionBy("for", "column")  # the values of one column
    shares = both.withColumns({"all": F.sum("n").over(whole), "all_before": F.sum("n_before").over(whole)}).where("all > 0 and all_before > 0")
    distance = F.max(F.abs(F.col("n") / F.col("all") - F.col("n_before") / F.col("all_before")))
    return (
        shares.groupBy("for", "column").agg(F.max("all").alias("n"), F.max("all_before").alias("n_before"), distance.alias("distance"))
        .join(names, "for").select("batch", "column", "n", "n_before", "distance", (F.col("distance") > reported).alias("drifted"))
    )
