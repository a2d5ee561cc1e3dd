"""The registered queries of this package, their expected results as SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import burst_trie, encoding, exact_dedup, imatch, language, merkle, packing, quality, secrets, sharding, simhash, token_counts, url_filter
from tidemark.llm.common import id_fold, written
from tidemark.llm.expected import STATEMENTS


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_table(spark, sf_dir, name) for name in ("documents", "labels"))
    scored = quality.score(spark, docs, labels, teaches=id_fold(F.col("doc_id"), 4) != 2)
    return scored.select("doc_id", (id_fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(spark, _table(spark, sf_dir, "documents"))


def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compare_edits(_table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.with_spans(_table(spark, sf_dir, "documents"), narrow=True)
    kinds = [rule.kind for rule in secrets.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    counts = [F.size(F.array_remove(F.transform("spans", lambda s: s["kind"] == F.lit(kind)), False)).cast("bigint").alias(f"n_{kind}") for kind in kinds]
    spans = secrets.written_out(F.col("spans"))
    return found.select("doc_id", *counts, F.sha2(secrets.written_out(base).cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.digests(encoding.encode(_table(spark, sf_dir, "documents")))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = id_fold(F.col("doc_id"), 5)
    found = language.identify(spark, _table(spark, sf_dir, "documents"), teaches=fold != 0)
    return found.select("doc_id", (fold == 0).alias("held_out"), "lang_pred", "score")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(spark, _table(spark, sf_dir, "documents")).drop("fp")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), keep=False)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = written(burst_trie.numbered_turns(_table(spark, sf_dir, "conversations")), "trie-numbered")
    return burst_trie.trie(spark, *burst_trie.with_shared_heads(turns))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The received copy of the rows whose id's crc32 is even has lost its line feeds.
    text, tampered = F.col("text"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    received = F.when(tampered, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    manifest = merkle.build(_table(spark, sf_dir, "documents"), received={"text": received})
    return merkle.climb(spark, manifest).withColumnRenamed("key", "doc_id")


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_exact_dedup, op3_imatch, op4_url_filter, op5_secret_scan, op6_sentencepiece, op7_language, op8_simhash, op9_sharding, op10_packing, op11_prefix_trie, op12_merkle, op13_token_counts)}


def statements() -> dict[str, str]:
    return dict(STATEMENTS)
