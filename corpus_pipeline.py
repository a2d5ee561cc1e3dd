"""Documents to packed training sequences: five stages, each written as Parquet and read by the next.

Documents that the quality classifier rejects go; of equal texts one stays; of near copies (SimHash of three-word
shingles within two bits) one stays; secrets are replaced in the text; what is left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, packing, quality, secrets, simhash
from tidemark.llm.common import id_fold, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.kept_documents(spark, docs, labels, teaches=id_fold(F.col("doc_id"), 4) != 2)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.kept_documents(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.kept_documents(spark, docs)


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("secret scans", replace_secrets),
    ("packing", pack_sequences),
]
#: A fitted model, fingerprints and token ids cannot be stated in SQL; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
