from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_of(
    facts: DataFrame, versions: DataFrame, key: str, at: str,
    valid_from: str = "dbt_valid_from", valid_to: str = "dbt_valid_to",
) -> DataFrame:
    """Inner join each fact to the version valid at its time: ``valid_from <= at < valid_to``, open end
    where ``valid_to`` is NULL.

    The key equality carries the join and the interval is a residual condition, so Spark broadcasts the
    versions when their size allows and otherwise sort-merges, where adaptive execution splits a hot
    key on the fact side.
    """
    f, v = facts.alias("f"), versions.alias("v")
    instant = F.col(f"f.{at}")
    still_valid = F.col(f"v.{valid_to}").isNull() | (instant < F.col(f"v.{valid_to}"))
    matched = (F.col(f"f.{key}") == F.col(f"v.{key}")) & (instant >= F.col(f"v.{valid_from}")) & still_valid
    extra = [F.col(f"v.{c}") for c in versions.columns if c not in facts.columns]
    return f.join(v, matched, "inner").select("f.*", *extra)


def distinct_keys(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """One row per key, to be joined on these keys with a side where one of them may be hot.

    Grouping by the keys alone would leave the rows already placed by key, and the join would then run on
    the aggregate without an exchange of its own; adaptive execution splits a hot key only between two
    plain exchanges. The hash as a further grouping column changes no group, but asks for that exchange,
    of one row per key.
    """
    counted = df.groupBy(*keys, F.xxhash64(*keys).alias("_key_hash"))
    unique = counted.agg(*[e.alias(n) for n, e in aggregates.items()]) if aggregates else counted.agg(F.lit(1).alias("_one"))
    return unique.select(*keys, *aggregates)


def with_known(
    rows: DataFrame, key: str, parent: DataFrame, keys: DataFrame, stage: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """Rows whose ``key`` occurs in the column of that name in ``parent``, as an inner join with a parent that holds each key
    once would choose them.

    Such keys are most of all, so it is the others that are sought: among ``keys``, which hold those of ``rows`` and may hold
    more, so that they can be had before a costly plan for ``rows``. ``stage`` writes the others under a name. Few of them
    are broadcast, by Spark's own decision, and the rows stay where they are; many meet the rows in an exchange.
    """
    unknown = stage(keys.select(key).distinct().join(parent.select(key), key, "left_anti").where(F.col(key).isNotNull()), f"unknown-{key}")
    return rows.where(F.col(key).isNotNull()).join(unknown, key, "left_anti")


def without_match(child: DataFrame, fk: str, parent: DataFrame, pk: str, null_fk: bool = True) -> DataFrame:
    """Child rows whose key has no parent. ``null_fk`` decides whether a NULL key counts."""
    rows = child if null_fk else child.where(F.col(fk).isNotNull())
    keys = distinct_keys(parent.select(F.col(pk).alias("_parent_key")), ["_parent_key"])
    return rows.join(keys, F.col(fk) == F.col("_parent_key"), "left_anti")
