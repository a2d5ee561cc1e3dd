"""Sharding by proportional stratified interleaving, in DataFrame functions only.

Rows are shuffled within each source by a seeded hash and ranked; rank r of n becomes the fraction (r - u) / n. The u of the
sources that have the same number of rows are spread evenly from 0 to 1, by a seeded shuffle of these sources, so that
many small sources fill the order as evenly as one large one. In the order of these fractions every stretch holds the sources in their overall proportions, and cutting the order into
equal stretches gives shards that all have the mixture; row counts differ by one at most.

No source and no shard is sorted in one task: ranks are a count over hash buckets plus a rank within a bucket, for
the sources (``_HASH_BUCKETS`` per source) as for the whole order (``_ORDER_BUCKETS`` slices of the unit interval).

Cases: rows without a source form a source of their own. A null text has no bytes. Rows that repeat in all columns
get places of their own. Empty table: empty result. Columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import without, written

_HASH_BUCKETS, _ORDER_BUCKETS = 1024, 4096
NAMES = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def shard(docs: DataFrame, shards: int = 24, seed: int = 7, keep: bool = True) -> DataFrame:
    """The columns of ``docs`` (with ``keep``; else doc_id alone), the size and crc32 of the text, shard and slot."""
    text = F.coalesce(F.col("text"), F.lit(""))
    others = without(docs, *NAMES) if keep else [F.col("doc_id")]
    names = [f"c{i}" for i in range(len(others))]
    titles = [c for c in docs.columns if c.lower() not in NAMES] if keep else ["doc_id"]
    source = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    mixed = F.xxhash64(F.lit(seed), F.col("doc_id"))
    rows = docs.select(
        *(c.alias(n) for c, n in zip(others, names)), source.alias("__source"), mixed.alias("__mixed"), F.col("doc_id").alias("__id"),
        F.pmod(mixed, F.lit(_HASH_BUCKETS)).cast("int").alias("__bucket"),
        (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    # Rows of a source before each of its buckets, and in all; the same for the sources of one size.
    of_source = Window.partitionBy("__source")
    counts = docs.select(source.alias("__source"), F.pmod(mixed, F.lit(_HASH_BUCKETS)).cast("int").alias("__bucket")).groupBy("__source", "__bucket").count()
    sized = counts.groupBy("__source").agg(F.sum("count").alias("__n")).select(
        F.col("__source").alias("__of"), "__n", F.xxhash64(F.lit(seed), "__source").alias("__hash"), F.pmod(F.xxhash64(F.lit(seed), "__source"), F.lit(_HASH_BUCKETS)).alias("__part")
    )
    alike = Window.partitionBy("__n")
    parts = sized.groupBy("__n", "__part").count().select(
        F.col("__n").alias("__m"), F.col("__part").alias("__p"), F.sum("count").over(alike).alias("__sources"),
        (F.sum("count").over(alike.orderBy("__part")) - F.col("count")).alias("__earlier"),
    )
    place = F.col("__earlier") + F.row_number().over(Window.partitionBy("__n", "__part").orderBy("__hash", "__of"))
    shifts = sized.join(parts, F.expr("__n = __m and __part = __p")).select("__of", ((place - 0.5) / F.col("__sources")).alias("__u"))
    offsets = counts.select(
        "__source", "__bucket", F.sum("count").over(of_source).alias("__n"),
        (F.sum("count").over(of_source.orderBy("__bucket")) - F.col("count")).alias("__before"),
    ).join(shifts, F.col("__source") == F.col("__of")).drop("__of")
    in_bucket = Window.partitionBy("__source", "__bucket").orderBy("__mixed", "__id", "text_crc32", "size")
    ranked = rows.join(offsets, ["__source", "__bucket"]).withColumn("__rank", F.col("__before") + F.row_number().over(in_bucket))
    fraction = (F.col("__rank") - F.col("__u")) / F.col("__n")
    placed = written(
        ranked.select(*names, "__source", "__mixed", "__id", "size", "text_crc32", fraction.alias("__f"), F.floor(fraction * _ORDER_BUCKETS).cast("int").alias("__slice")),
        "sharding",
    )
    slices = placed.groupBy("__slice").count()  # at most _ORDER_BUCKETS rows, so one window task and a broadcast
    whole = Window.partitionBy(F.lit(0))
    starts = slices.select(
        "__slice", F.sum("count").over(whole).alias("__all"), (F.sum("count").over(whole.orderBy("__slice")) - F.col("count")).alias("__first")
    )
    in_slice = Window.partitionBy("__slice").orderBy("__f", "__source", "__mixed", "__id", "text_crc32", "size")
    at = placed.join(F.broadcast(starts), "__slice").withColumn("__at", F.col("__first") + F.row_number().over(in_slice) - 1)
    number = F.expr(f"(__at * {shards}L) div __all")
    return at.withColumn("shard", number).select(
        *(F.col(n).alias(t) for n, t in zip(names, titles)), "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("__at") - F.expr(f"(shard * __all + {shards - 1}L) div {shards}L")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
