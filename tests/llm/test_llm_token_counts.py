"""Token counts against the library, which encodes each whole text at once."""

import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidemark.llm import queries, token_counts
from tidemark.llm.pieces import default_path

SF = "/root/testdata/sf0.001"
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=default_path())


def strange_texts(seed, number, longest):
    random.seed(seed)
    alphabets = ["ab", "aA1+/=", "the and of ", "▁ a", "漢字测试", "\U0001f600‍\U0001f468é", "\n\t  x", "éüß ñ", "0123456789", "".join(map(chr, range(33, 127)))]
    for _ in range(number):
        size = random.randint(1, longest)
        text = ""
        while len(text) < size:
            letters = random.choice(alphabets)
            text += random.choice([random.choice(letters) * random.randint(1, 300), "".join(random.choices(letters, k=random.randint(1, 200)))])
        yield text[:size]


def test_token_ends_spell_the_text():
    encoder = token_counts.loaded(default_path())
    for text in strange_texts(3, 200, 400):
        n, ends, at = encoder.ends(text)
        assert n == len(LIBRARY.encode(text)) and list(ends) == sorted(set(ends)) and all(0 < e < len(text) for e in ends)
        for end, before in zip(ends.tolist()[:5], at.tolist()[:5]):
            assert LIBRARY.decode(LIBRARY.encode(text)[:before]) == text[:end].replace("▁", " ")


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 4), (200, 16), (1000, 64)])
def test_spliced_counts_are_the_whole_texts_counts(spark, chunk, overlap):
    texts = [*strange_texts(chunk, 120, 5000), "a" * 5000, "ab" * 3000, " " * 4000, "x" + "▁" * 3000, "漢" * 3000, "\U0001f9ff" * 2000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, chunk=chunk, overlap=overlap).collect()}
    assert found == {i: len(LIBRARY.encode(t)) for i, t in enumerate(texts)}


def test_overlaps_widen_until_the_chunks_agree(spark):
    # A run whose tokens of sixteen letters start where the chunk starts agrees nowhere, so it becomes one chunk.
    texts = spark.createDataFrame([("run", "a" * 5000 + "b"), ("words", "some plain words " * 300)], "digest string, body string")
    found, rounds = token_counts.huge_counts(texts, default_path(), chunk=100, overlap=5)
    assert rounds > 2 and {r.digest: r.n_tokens for r in found.collect()} == {"run": len(LIBRARY.encode("a" * 5000 + "b")), "words": len(LIBRARY.encode("some plain words " * 300))}
    _, rounds = token_counts.huge_counts(texts.where("digest = 'words'"), default_path(), chunk=1000, overlap=30)
    assert rounds == 1


def test_long_texts_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "_BLOCK", 1000)
    texts = list(strange_texts(11, 20, 30_000))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, chunk=300, overlap=20).collect()}
    assert found == {i: len(LIBRARY.encode(t)) for i, t in enumerate(texts)}


def test_a_megabyte_in_one_word(spark):
    random.seed(5)
    text = "".join(random.choices("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/", k=1_000_000))
    docs = spark.createDataFrame([(1, text), (2, text), (3, text[:-1])], "doc_id bigint, text string")
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs).collect()}
    assert found == {i: (len(t), len(LIBRARY.encode(t)), True) for i, t in ((1, text), (2, text), (3, text[:-1]))}


def test_odd_rows(spark):
    rows = [(1, "a b", 5), (1, "a b", 5), (None, "x" * 300, None), (2, None, 1), (3, "", 2), (3, "x" * 300, None), (4, "line\nline", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, N_tokens int").withColumns({"digest": F.lit("d"), "c0": F.lit(0), "body": F.lit("b")})
    found = token_counts.count_tokens(docs, chunk=100, overlap=10)
    assert found.columns == ["doc_id", "text", "digest", "c0", "body", "n_bytes", "n_tokens", "over_limit"]
    have = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.digest, r.c0) for r in found.collect()), key=repr)
    assert have == sorted(((i, len(t or ""), len(LIBRARY.encode(t or "")), "d", 0) for i, t, _ in rows), key=repr)
    assert token_counts.count_tokens(docs.limit(0)).count() == 0


def test_query_over_all_documents(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.registered()["op13_token_counts"](spark, SF)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    have = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in found.collect()}
    counts = {i: len(LIBRARY.encode(t)) for i, t in texts.items()}
    assert have == {i: (len(t.encode()), counts[i], counts[i] > 4096) for i, t in texts.items()}
