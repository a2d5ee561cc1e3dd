"""Exact deduplication: groups, order, hits with equal digests, several micro-batches, odd input."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup

SCHEMA = "doc_id bigint, text string, lang string, digest string, stable string, kept string"


def frame(spark, *pairs):
    return spark.createDataFrame([(i, t, "en", "x", "y", "z") for i, t in pairs], SCHEMA)


def found(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=repr)


CASES = [(5, "a  b\t\nc"), (3, "a b c"), (9, None), (7, ""), (4, "a b  c "), (None, "a b c"), (1, "long " * 50_000), (2, "long\n" * 50_000)]
EXPECTED = sorted([(5, 3, 3, False), (3, 3, 3, True), (None, 3, 3, False), (9, 7, 2, False), (7, 7, 2, True), (4, 4, 1, True), (1, 1, 2, True), (2, 1, 2, False)], key=repr)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda text: F.crc32(text.cast("binary")) % 2, lambda text: F.lit(0)])
def test_groups_whatever_the_digest_tells_apart(spark, digest):
    docs = frame(spark, *CASES).repartition(3)
    assert found(exact_dedup.dedup(spark, docs, lambda t: digest(t).cast("string"))) == EXPECTED


def test_many_micro_batches_keep_the_least_id(spark):
    docs = frame(spark, *((i, f"text {i % 7}") for i in range(60))).repartition(6)
    out = exact_dedup.dedup(spark, docs, files_per_batch=1).collect()
    assert {(r.keep_id, r.kept) for r in out if r.kept} == {(i, True) for i in range(7)}
    assert all(r.keep_id == r.doc_id % 7 and r.group_size == (9 if r.doc_id % 7 < 4 else 8) for r in out)


def test_rows_repeated_with_their_id_keep_one(spark):
    out = exact_dedup.dedup(spark, frame(spark, (1, "a"), (1, "a"), (None, "b"), (None, "b")).repartition(2)).collect()
    assert sorted((r.group_size, r.kept) for r in out) == [(2, False), (2, False), (2, True), (2, True)]
    kept = exact_dedup.kept_documents(spark, frame(spark, (1, "a"), (1, "a"), (None, "b"), (2, "b  c"), (3, "b c")))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == [(1, "a"), (2, "b  c"), (None, "b")]
    assert kept.columns == SCHEMA.replace(",", "").split()[::2]


def test_empty_table(spark):
    assert exact_dedup.dedup(spark, frame(spark)).collect() == []


def test_a_text_of_a_third_of_all_rows(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    out = exact_dedup.dedup(spark, docs)
    assert out.where("keep_id = 0").count() == 1000 and out.where("kept").count() == 2001
