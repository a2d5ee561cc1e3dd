"""Sharding: counts, places, the mixture of every shard, a hot source, odd input."""

import zlib
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import sharding


def check(rows, shards):
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min([*sizes.values(), 0 if len(sizes) < shards else max(sizes.values())]) <= 1
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_every_shard_has_the_mixture(spark):
    docs = spark.range(9000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("é "), F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, None).otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        F.lit(1).alias("Slot"),
    )
    rows = sharding.shard(docs, shards=24).collect()
    check(rows, 24)
    assert len(rows) == 9000 and {r.doc_id for r in rows} == set(range(9000)) and rows[0].asDict().keys() >= {"source", "text", "slot"}
    total, by_shard = Counter(r.source for r in rows), Counter((r.shard, r.source) for r in rows)
    assert all(abs(n - total[source] / 24) <= 1.01 for (_, source), n in by_shard.items())
    assert all((r["size"], r.text_crc32) == (len(r.text.encode()) + 8, zlib.crc32(r.text.encode())) for r in rows)
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot)) if r.source == "hot"]
    assert sorted(order) != order and rows != sharding.shard(docs, shards=24, seed=8).collect()


def test_same_places_whatever_the_partitions(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), (F.col("id") % 3).cast("string").alias("source"))
    places = [sorted((r.doc_id, r.shard, r.slot) for r in sharding.shard(docs.repartition(n), keep=False).collect()) for n in (1, 5)]
    assert places[0] == places[1]


def test_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "", "a"), (None, "x" * 100_000, "a"), (2, "b", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = sharding.shard(docs, shards=3).collect()
    check(out, 3)
    assert sorted(r["size"] for r in out) == [8, 8, 8, 9, 100_008] and {r.law for r in out} == {"rows"} and {r.grown_shard for r in out} == {None}
    assert sharding.shard(docs.limit(0)).collect() == []


def test_many_small_sources_leave_room_for_the_others(spark):
    """10,000 rows of one source and 10,000 sources of one row: every shard has its share of both, and no slice is full."""
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") < 10_000, "big").otherwise(F.concat(F.lit("host"), F.col("id"))).alias("source")
    )
    rows = sharding.shard(docs, shards=24).collect()
    check(rows, 24)
    big = Counter(r.shard for r in rows if r.source == "big")
    assert len(big) == 24 and set(big.values()) <= {416, 417}


def test_no_python_runs_on_executors(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = sharding.shard(docs, keep=False)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
