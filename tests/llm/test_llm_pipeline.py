"""The pipeline's stages against plain versions of them, on odd documents and on the given ones."""

import re

import pytest
from pyspark.sql import functions as F
from test_llm_secrets import plain_base
from test_llm_simhash import plain_components, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import exact_dedup, packing, quality, secrets, simhash
from tidemark.llm.common import id_fold, written

SF = "/root/testdata/sf0.001"


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_follow_each_other(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "SimHash near-dedup", "secret scans", "packing"] and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    steps = []
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        now = written(stage(spark, now, SF), "test")
        steps.append(now)
        assert name == "packing" or now.columns == docs.columns

    good = {r.doc_id for r in quality.score(spark, docs, labels, id_fold(F.col("doc_id"), 4) != 2).where("predicted = 1").collect()}
    texts = {i: r.text for i, r in by_id(docs).items() if i in good}
    assert set(by_id(steps[0])) == good and 0 < len(good) < docs.count()

    first = {}
    for i in sorted(texts):
        first.setdefault(re.sub("[ \t-\r]+", " ", texts[i]), i)
    texts = {i: texts[i] for i in first.values()}
    assert set(by_id(steps[1])) == set(texts)

    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    roots = plain_components(near, texts)
    texts = {i: t for i, t in texts.items() if roots[i] == i}
    assert set(by_id(steps[2])) == set(texts)

    clean = by_id(steps[3])
    assert set(clean) == set(texts)
    for i, t in texts.items():
        assert (clean[i].text == t) == (not plain_base(t)) or not plain_base(t), i
        assert not plain_base(clean[i].text) and clean[i].n_chars == len(clean[i].text)

    tokenizer = Tokenizer.from_file(__import__("public_tokenizers").path("byte_bpe_50k.json"))
    want = {i: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in clean.items()}
    have = {}
    for r in steps[4].collect():
        have[r.doc_id] = have.get(r.doc_id, 0) + r.length
    assert have == want


ROWS = [(1, "a b c d", "en", "s", 7), (1, "a b c d", "en", "s", 7), (None, "a b c d", None, None, None), (2, None, "en", "s", 0), (3, "", "en", "s", 0), (4, "x" * 60_000, "en", "s", 60_000), (5, "token=abcdefgh", "en", "s", 14)]


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_odd_rows_go_through_each_stage(spark, odd):
    deduped = exact_dedup.kept_documents(spark, odd)
    assert sorted(((r.doc_id, r.text) for r in deduped.collect()), key=repr) == sorted([(1, "a b c d"), (2, None), (4, "x" * 60_000), (5, "token=abcdefgh")], key=repr)
    # Without an id a row is never a copy; ids 2 and 3 have no words.
    assert sorted((r.doc_id for r in simhash.kept_documents(spark, odd).collect()), key=repr) == sorted([1, 1, None, 2, 4, 5], key=repr)
    redacted = {r.doc_id: (r.text, r.n_chars) for r in secrets.redacted_documents(odd).collect()}
    assert redacted[5] == ("[SECRET]", 8) and redacted[2] == (None, 0) and redacted[4][1] == 60_000
    assert sum(r.length for r in packing.pack(odd).where("doc_id = 2").collect()) == 1


def test_empty_documents(spark, odd):
    now = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF)
        assert now.count() == 0


def test_large_decision_tables_do_not_change_results(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t "), (F.col("id") % 1000).cast("string")).alias("text"))
    kept = exact_dedup.kept_documents(spark, docs)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(1000))
