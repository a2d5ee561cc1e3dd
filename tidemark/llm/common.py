"""What the operators of this package share: written intermediates, fixed-size membership bitmaps, row filters."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir


def fresh_path(spark: SparkSession, name: str) -> str:
    """A folder of its own in the storage that driver and executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to shared storage and read back: cuts lineage, and a lost executor loses nothing."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; rows without an id are in no fold (null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


_WORD_BITS = 64


def hash_bitmap(keys: DataFrame, column: str, slots: int = 1 << 20) -> DataFrame:
    """One row, one column: ``slots`` bits as array<bigint>, set where the hash of a key falls.

    The size is fixed by ``slots`` (128 KB at the default) and does not depend on the number of keys; the
    words are combined by a partial aggregate. Test with ``in_bitmap``: never misses a key, and passes other
    values in proportion to how full the bitmap is, so what passes must be checked or be harmless.
    """
    slot = F.pmod(F.xxhash64(F.col(column)), F.lit(slots))
    words = keys.select((slot / _WORD_BITS).cast("int").alias("w"), (slot % _WORD_BITS).cast("int").alias("b"))
    filled = words.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits"))
    every = keys.sparkSession.range(slots // _WORD_BITS).select(F.col("id").cast("int").alias("w"))
    ordered = every.join(F.broadcast(filled), "w", "left").select("w", F.coalesce("bits", F.lit(0)).alias("bits"))
    return ordered.agg(F.array_sort(F.collect_list(F.struct("w", "bits"))).alias("words")).select(
        F.col("words.bits").alias("bitmap")
    )


def in_bitmap(bitmap: Column, value: Column, slots: int = 1 << 20) -> Column:
    """Whether the slot of ``value`` is set in ``bitmap`` (``hash_bitmap``)."""
    slot = F.pmod(F.xxhash64(value), F.lit(slots))
    word = F.element_at(bitmap, (slot / _WORD_BITS).cast("int") + 1)
    return F.bit_get(word, (slot % _WORD_BITS).cast("int")) == 1


def slots_for(rows: int) -> int:
    """Slots that leave a bitmap for so many keys sparse: 2**20 (128 KB) to 2**25 (4 MB), whatever the number."""
    return min(max(1 << 20, 1 << (16 * rows).bit_length()), 1 << 25)


def marked_rows(docs: DataFrame, key: Column, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` in two parts: rows whose ``key`` is surely not in ``decisions`` (key, ...), and the others, left-joined
    with it. Only the others are shuffled. ``decisions`` is a written table with one row for each key.

    The exchange is a merge join at every size, so that a plan seen on little data is the plan on much."""
    slots = slots_for(decisions.count())
    bitmap = hash_bitmap(decisions, "key", slots).scalar()
    hit = in_bitmap(bitmap, key, slots)
    maybe = docs.where(hit).withColumn("__key", key)
    return docs.where(~hit | hit.isNull()), maybe.join(decisions.hint("merge"), F.expr("__key <=> key"), "left")


def without(df: DataFrame, *names: str) -> list[Column]:
    """The columns of ``df`` but those whose name, in either case, an operator is about to write."""
    taken = {n.lower() for n in names}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
