"""Incremental reads of relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FETCH_ROWS = 10_000
#: Of the quantile sketch: its shares are off by half a percent at most, nearly always.
_SKETCH_SIZE = 800


def jdbc_options(
    url: str, table: str, split_column: str, bounds: tuple, splits: int = 16
) -> dict[str, str]:
    """Reader options: the table is read in parallel ranges of the split column. Without a column and its
    bounds the whole table would come through one task, so both must be given."""
    if not split_column or bounds is None or None in bounds:
        raise ValueError("a relational scan needs a split column with its lower and upper bound")
    return {
        "url": url, "dbtable": table, "fetchsize": str(FETCH_ROWS), "partitionColumn": split_column,
        "numPartitions": str(splits), "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]),
    }


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def equal_depth_bounds(loaded: DataFrame, column: str, splits: int) -> list[int]:
    """Ascending values of a whole-number column that cut ``loaded``, say the last load, into ranges of about equal rows,
    however its values are spread. A value that many rows share is not cut, so there may be fewer than ``splits`` ranges.
    Decimals, which may be wider than BIGINT, are sketched as doubles; their cuts are rounded down."""
    shares = F.array(*(F.lit(k / splits) for k in range(1, splits)))
    if loaded.schema[column].dataType.typeName() == "decimal":
        sketch = F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(_SKETCH_SIZE))
        cuts = F.transform(F.kll_sketch_get_quantile_double(sketch, shares), lambda cut: F.floor(cut.cast("decimal(38,0)")))
    else:
        sketch = F.kll_sketch_agg_bigint(F.col(column).cast("bigint"), F.lit(_SKETCH_SIZE))
        cuts = F.kll_sketch_get_quantile_bigint(sketch, shares)
    found = loaded.where(F.col(column).isNotNull()).agg(F.when(F.count(F.lit(1)) > 0, cuts)).first()[0] if splits > 1 else None
    return sorted({int(cut) for cut in found or []})  # splits - 1 values


def range_predicates(column: str, bounds: list[int]) -> list[str]:
    """Conditions that hold for each row exactly once: the first also takes rows without a value, the first and the last
    whatever lies beyond the bounds by now."""
    if not bounds:
        return ["1 = 1"]
    inner = [f"{column} > {low} and {column} <= {high}" for low, high in zip(bounds, bounds[1:])]
    return [f"{column} <= {bounds[0]} or {column} is null", *inner, f"{column} > {bounds[-1]}"]


def read_jdbc_ranges(spark: SparkSession, url: str, table: str, predicates: list[str], **properties: str) -> DataFrame:
    """One task for each of ``predicates``."""
    return spark.read.jdbc(url, table, predicates=predicates, properties={"fetchsize": str(FETCH_ROWS), **properties})


def increment(table: DataFrame, columns: list[str], mark_column: str, since=None, with_unmarked: bool = False) -> DataFrame:
    """Only the declared columns and only rows above the mark. Both are plain DataFrame steps, so they
    reach the source: a JDBC table receives them as its WHERE clause and column list, a file scan as
    pushed filters and read schema."""
    rows = table.select(*columns)
    if since is None:
        return rows
    # A stored mark is text; the comparison stays one of native values, which the source can take over.
    newer = F.col(mark_column) > F.lit(since).cast(table.schema[mark_column].dataType)
    return rows.where(newer | F.col(mark_column).isNull() if with_unmarked else newer)


def as_text(df: DataFrame) -> DataFrame:
    """Native values in the raw layer's text form."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def high_mark(df: DataFrame, mark_column: str) -> DataFrame:
    return df.agg(F.max(F.col(mark_column).cast("string")).alias("max_mark"))
