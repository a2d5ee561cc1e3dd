from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import LOOKBACK_DAYS


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched keys take the source row whole, new keys are added, nothing is deleted. Columns that only
    one side has are kept, NULL on the other. ``source`` must hold each key once."""
    replaced = source.select(*keys)
    return target.join(replaced, list(keys), "left_anti").unionByName(source, allowMissingColumns=True)


def lookback_cut(target: DataFrame, field: str = "updated_at", days: int = LOOKBACK_DAYS):
    """``max(field) - days`` as a Python value, or None on an empty target. A literal, unlike a
    subquery, prunes row groups and files when it is pushed to the scan."""
    cut = F.max(field) - F.make_dt_interval(F.lit(days))
    return target.agg(cut.alias("cut")).first()["cut"]


def since_cut(field: str, cut, text_form: str | None = None) -> Column:
    """Strictly newer than the cut; everything when there is none.

    With ``text_form`` (say ``%Y-%m-%dT%H:%M:%SZ``) the field is text in that one form throughout, and is
    compared as text, which a scan can use to skip row groups. Otherwise it is compared as a time.
    """
    if cut is None:
        return F.lit(True)
    if text_form:
        return F.col(field) > F.lit(cut.strftime(text_form))
    return F.col(field).cast("timestamp_ntz") > F.lit(str(cut)).cast("timestamp_ntz")


def increment_before_dedup(raw: DataFrame, order_by: str, cut, text_form: str | None = None) -> DataFrame:
    """Filter a raw table to the increment *before* the latest-version dedup.

    Same rows as filtering afterwards, because a key passes only if its newest row passes, and then
    that row is in the filtered set. Holds only where dedup and filter use the same column.
    """
    return raw.where(since_cut(order_by, cut, text_form))
