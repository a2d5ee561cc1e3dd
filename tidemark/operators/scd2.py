"""Type 2 history with the timestamp strategy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import distinct_keys

VALID_FROM, VALID_TO = "dbt_valid_from", "dbt_valid_to"
VERSION_ID, VERSION_TIME = "dbt_scd_id", "dbt_updated_at"


def version_id(key: str, updated_at: str) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit("|"), F.col(updated_at).cast("string")))


def open_versions(source: DataFrame, key: str, updated_at: str = "updated_at") -> DataFrame:
    """Every source row as a version that is valid from its own update time on."""
    return source.withColumns({
        VERSION_ID: version_id(key, updated_at),
        VERSION_TIME: F.col(updated_at),
        VALID_FROM: F.col(updated_at),
        VALID_TO: F.lit(None).cast("timestamp_ntz"),
    })


def snapshot(
    history: DataFrame, source: DataFrame, key: str, run_at: str,
    updated_at: str = "updated_at", close_missing: bool = True,
) -> DataFrame:
    """Apply one source snapshot (one row per key) to the version history.

    Open versions and source meet once, in a full outer join in which both sides hold each key once.
    Each joined pair then yields its one or two resulting versions in place. Closed versions are passed
    through and never shuffled.
    """
    closed = history.where(F.col(VALID_TO).isNotNull())
    current = history.where(F.col(VALID_TO).isNull())
    columns = history.columns

    new = open_versions(source, key, updated_at).select(
        F.col(key).alias("_key"), F.struct(*columns).alias("new")
    )
    old = current.select(F.col(key).alias("_key"), F.struct(*columns).alias("old"))
    pair = old.join(new, "_key", "full")

    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    changed = has_old & has_new & (F.col(f"new.{updated_at}") > F.col(f"old.{updated_at}"))
    gone = has_old & ~has_new & F.lit(close_missing)

    superseded = F.col("old").withField(VALID_TO, F.col(f"new.{updated_at}"))
    removed = F.col("old").withField(VALID_TO, F.lit(run_at).cast("timestamp_ntz"))
    results = (
        F.when(changed, F.array(superseded, F.col("new")))
        .when(gone, F.array(removed))
        .when(has_old, F.array(F.col("old")))
        .otherwise(F.array(F.col("new")))
    )
    return closed.unionByName(pair.select(F.inline(results)).select(*columns))


def structure_violations(history: DataFrame, key: str) -> DataFrame:
    """Versions without a start, or that end before they start."""
    backwards = F.col(VALID_TO).isNotNull() & (F.col(VALID_TO) <= F.col(VALID_FROM))
    return history.where(F.col(VALID_FROM).isNull() | backwards).select(key)


def duplicate_versions(history: DataFrame, key: str) -> DataFrame:
    """Rows that share (key, start) with another row. Groups are counted with map-side combine first;
    only the rare repeated ones are joined back."""
    repeated = distinct_keys(history, [key, VALID_FROM], cnt=F.count(F.lit(1))).where("cnt > 1")
    h, r = history.alias("h"), repeated.alias("r")
    same = F.col(f"h.{key}").eqNullSafe(F.col(f"r.{key}")) & F.col(f"h.{VALID_FROM}").eqNullSafe(
        F.col(f"r.{VALID_FROM}")
    )
    return h.join(r, same).select(f"h.{key}", f"h.{VALID_FROM}", "r.cnt")


def with_next_start(history: DataFrame, key: str) -> DataFrame:
    """Adds ``next_valid_from``, the start of the following version of the same key.

    A plain ``lead`` over the key would put all versions of one key into one task. Here ``lead`` runs
    within (key, month); the last version of a month takes the first start of the key's next month that
    has any, found over one row per key and month.
    """
    monthly = history.withColumn("_month", F.trunc(F.col(VALID_FROM).cast("date"), "month"))
    in_month = Window.partitionBy(key, "_month").orderBy(VALID_FROM, VERSION_ID)
    across = Window.partitionBy(key).orderBy("_month")
    first_of_month = (
        monthly.groupBy(key, "_month").agg(F.min(VALID_FROM).alias("_first"))
        .withColumn("_first_later", F.lead("_first").over(across))
        .drop("_first")
    )
    m, n = monthly.withColumn("_lead", F.lead(VALID_FROM).over(in_month)).alias("m"), first_of_month.alias("n")
    same = (F.col(f"m.{key}") == F.col(f"n.{key}")) & F.col("m._month").eqNullSafe(F.col("n._month"))
    following = F.coalesce(F.col("m._lead"), F.col("n._first_later"))
    return m.join(n, same, "left").select(
        *[F.col(f"m.{c}") for c in history.columns], following.alias("next_valid_from")
    )


#: Names of the broken rules in the report.
SEVERAL_OPEN, GAP, NO_START = "multiple_current", "validity_gap", "null_valid_from"


def violations(history: DataFrame, key: str) -> DataFrame:
    """(issue, key, detail), one row per broken rule, from one pass over the versions: a key has one open
    version at most, a version ends where the next begins, and every version has a start.

    A version says which of its own rules it breaks; an open one also casts a vote for its key, and keys
    with several votes are reported. Only votes and broken versions are grouped.
    """
    ends, follows = F.col(VALID_TO), F.col("next_valid_from")
    apart = F.col(VALID_FROM).isNotNull() & (ends != follows)
    found = F.array_compact(F.array(
        F.when(ends.isNull(), _issue(SEVERAL_OPEN, F.lit(None).cast("string"))),
        F.when(apart, _issue(GAP, F.concat_ws(" -> ", F.col(VALID_FROM).cast("string"), follows.cast("string")))),
        F.when(F.col(VALID_FROM).isNull(), _issue(NO_START, F.col(VERSION_ID).cast("string"))),
    ))
    reported = with_next_start(history, key).select(key, F.inline(found)).groupBy("issue", key, "detail").agg(F.count(F.lit(1)).alias("n"))
    vote = F.col("issue") == SEVERAL_OPEN
    return reported.where(~vote | (F.col("n") > 1)).select("issue", key, F.when(vote, F.col("n").cast("string")).otherwise(F.col("detail")).alias("detail"))


def _issue(name: str, detail: Column) -> Column:
    return F.struct(F.lit(name).alias("issue"), detail.alias("detail"))
