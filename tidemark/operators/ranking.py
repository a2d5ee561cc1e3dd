"""Global order statistics without a one-partition window over the data.

A whole-number value is mapped, monotonically, to one of a bounded number of value bands: its binary order of
magnitude plus the ``MANTISSA_BITS`` bits after the leading one. Values are first counted per distinct
value (ties and hot values collapse there). A band is cut into 2^``SLICE_BITS`` slices of equal width
between the least and the greatest value it has, so values that lie close together are told apart by their
later bits. Values are ordered inside a slice, slices inside a band, in parallel; only the band totals,
whose number is bounded by construction, are ordered in one task. The result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MANTISSA_BITS = 10
SLICE_BITS = 10


def value_band(value: Column) -> Column:
    """Monotone in ``value`` (a bigint); at most 2 · 63 · 2^MANTISSA_BITS different results."""
    size = F.abs(value)
    # Length of the binary form, minus one, is the exponent. Unlike log2 it is exact.
    exponent = F.length(F.bin(size)) - 1
    shift = F.greatest(exponent - MANTISSA_BITS, F.lit(0))
    band = exponent * F.lit(1 << (MANTISSA_BITS + 1)) + F.call_function("shiftright", size, shift)
    return F.when(value < 0, -band - 1).otherwise(band).cast("bigint")


def value_slice(value: Column, least: Column, most: Column) -> Column:
    """Monotone in ``value`` between ``least`` and ``most`` of one band: at most 2^SLICE_BITS + 1 results. A
    band is no wider than 2^(63 - MANTISSA_BITS), so nothing overflows."""
    width = F.call_function("shiftright", most - least, F.lit(SLICE_BITS)) + 1
    return F.floor((value - least) / width).cast("bigint")


def running_counts(values: DataFrame, value: str, descending: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, value, rows, before, total): for each distinct non-NULL value, the number of rows that come
    before it and the number of all rows, over the whole table or within each ``by`` group. A group may
    hold any share of the rows: its bands are ordered in parallel too."""
    def way(column):
        return F.col(column).desc() if descending else F.col(column).asc()

    counted = (
        values.where(F.col(value).isNotNull())
        .groupBy(*by, value).agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("_band", value_band(F.col(value)))
        # The filter the join below would infer; stated here, both its sides share one exchange.
        .where(F.col("_band").isNotNull())
    )
    preceding = (Window.unboundedPreceding, -1)
    ends = counted.groupBy(*by, "_band").agg(F.min(value).alias("_least"), F.max(value).alias("_most"), F.sum("rows").alias("_rows"))
    # One row per band: the only window a single task may hold whole.
    earlier_bands = Window.partitionBy(*by).orderBy(way("_band")).rowsBetween(*preceding)
    bands = ends.withColumns({
        "_before_band": F.coalesce(F.sum("_rows").over(earlier_bands), F.lit(0)),
        "total": F.sum("_rows").over(Window.partitionBy(*by)),
    }).drop("_rows")
    sliced = counted.join(bands, [*by, "_band"]).withColumn("_slice", value_slice(F.col(value), F.col("_least"), F.col("_most")))
    per_slice = sliced.groupBy(*by, "_band", "_slice").agg(F.sum("rows").alias("_rows"))
    earlier_slices = Window.partitionBy(*by, "_band").orderBy(way("_slice")).rowsBetween(*preceding)
    slices = per_slice.withColumn("_before_slice", F.coalesce(F.sum("_rows").over(earlier_slices), F.lit(0))).drop("_rows")
    earlier_values = Window.partitionBy(*by, "_band", "_slice").orderBy(way(value)).rowsBetween(*preceding)
    before = F.col("_before_band") + F.col("_before_slice") + F.coalesce(F.sum("rows").over(earlier_values), F.lit(0))
    return sliced.join(slices, [*by, "_band", "_slice"]).withColumn("before", before).select(
        *by, value, "rows", "before", "total"
    )


def with_rank(df: DataFrame, value: str, rank: str, descending: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """SQL ``rank()`` by a bigint column, over the whole table or within ``by`` (whose columns must not
    be NULL); NULL values share the last rank. ``df`` is used twice, so hand in a written table where
    it is costly."""
    last = F.lit(-(2**63) + 1 if descending else 2**63 - 1)
    keyed = df.withColumn("_value", F.coalesce(F.col(value), last))
    ranked = running_counts(keyed, "_value", descending, by).select(
        *by, "_value", (F.col("before") + 1).alias(rank)
    )
    return keyed.join(ranked, [*by, "_value"]).drop("_value")


def exact_median(df: DataFrame, value: str, alias: str = "median") -> DataFrame:
    """One row: the exact median of a bigint column (mean of the two middle rows when even)."""
    counts, total = running_counts(df, value), F.col("total")
    # 0-based positions of the two middle rows; they coincide for an odd number of rows.
    low, high = F.floor((total - 1) / 2), F.floor(total / 2)
    first, last = F.col("before"), F.col("before") + F.col("rows") - 1
    return counts.where((last >= low) & (first <= high)).agg(
        ((F.min(value) + F.max(value)) / F.lit(2.0)).alias(alias)
    )
