"""Packing: token ids as the public library gives them, every id in one piece, no padding, balanced steps."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import byte_bpe, packing


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(" \n\tab's.,1é\x85\x1c\u3000\u00a0", max_size=40)))
def test_ids_are_those_of_the_library(library, text):
    assert np.frombuffer(byte_bpe.loaded(byte_bpe.default_path()).encode(text), "<u4").tolist() == library(text)


def test_ids_of_given_texts(library, spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + ["<|endoftext|> a", "don't\n\n x ", " \n", "a" * 3000]
    tokenizer = byte_bpe.loaded(byte_bpe.default_path())
    assert all(np.frombuffer(tokenizer.encode(t), "<u4").tolist() == library(t) for t in texts)


@pytest.fixture(scope="module")
def as_loaded():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", "<|", " ", "  ", "\n", "a", "'s", "é", "the end", "<|ENDOFTEXT|>"]), max_size=12).map("".join))
def test_added_tokens_in_a_text_have_their_own_ids(as_loaded, text):
    assert np.frombuffer(byte_bpe.loaded(byte_bpe.default_path()).encode_document(text), "<u4").tolist() == as_loaded(text)


def test_pieces_of_documents_with_added_tokens(spark, as_loaded):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y " * 400, "no token <|endoftext"]
    assert as_loaded(texts[0]) == [64, 220, 50256, 275]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    for i, text in enumerate(texts):
        tokens, own = [*as_loaded(text), packing.END_ID], [r for r in rows if r.doc_id == i]
        assert sum(r.length for r in own) == len(tokens)
        assert all(r.ids_crc32 == zlib.crc32(np.array(tokens[r.start : r.start + r.length], "<u4").tobytes()) and r.doc_tokens == len(tokens) for r in own)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5000), max_size=60))
def test_units_are_full(sizes):
    sequences = packing.pack_unit(sizes)
    pieces = sorted(p for s in sequences for p in s)
    for doc, size in enumerate(sizes):
        at = 0
        for start, length in ((s, n) for d, s, n in pieces if d == doc):
            assert start == at
            at += length
        assert at == size
    totals = [sum(n for _, _, n in s) for s in sequences]
    assert all(t <= 2048 and t & (t - 1) == 0 for t in totals) and sum(t not in packing.TIERS for t in totals) <= 8 * len(packing.TIERS)


def test_step_groups_are_of_one_length_and_balanced():
    draw = random.Random(3)
    sequences = packing.pack_unit([draw.choice([30, 300, 900, 2500]) + draw.randrange(200) for _ in range(2000)])
    groups = {}
    for sequence, group in zip(sequences, packing.step_groups(sequences, 1 << 14)):
        groups.setdefault(group, []).append(sequence)
    by_length = {}
    for members in groups.values():
        lengths = {sum(p[2] for p in s) for s in members}
        assert len(lengths) == 1 and len(members) * max(lengths) <= 1 << 14
        by_length.setdefault(lengths.pop(), []).append([sum(sum(p[2] ** 2 for p in s) for s in members) / len(members)])
    costs = [c for (c,) in by_length[2048]]
    assert max(costs) <= 1.35 * min(costs)


def test_pieces_of_documents(spark, library):
    texts = [None, "", "x", "a " * 5000, "the end", "the end", "tab\tand  spaces " * 300]
    docs = spark.createDataFrame([(i if i != 2 else None, t, 5) for i, t in enumerate(texts)], "doc_id bigint, text string, length int").repartition(2)
    rows = packing.pack(docs, unit_tokens=500).collect()
    ids = {i if i != 2 else None: [*library(t or ""), packing.END_ID] for i, t in enumerate(texts)}
    for key, tokens in ids.items():
        own = sorted((r for r in rows if r.doc_id == key), key=lambda r: r.start)
        assert [r.start for r in own] == list(np.cumsum([0] + [r.length for r in own])[:-1]) and sum(r.length for r in own) == len(tokens)
        assert all(r.ids_crc32 == zlib.crc32(np.array(tokens[r.start : r.start + r.length], "<u4").tobytes()) and r.doc_tokens == len(tokens) for r in own)
    sequences = {}
    for r in rows:
        sequences.setdefault((r.sequence_id, r.tier), []).append(r)
    assert len({s for s, _ in sequences}) == len(sequences)
    for (_, tier), own in sequences.items():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == list(np.cumsum([0] + [r.length for r in own])[:-1]) and sum(r.length for r in own) == tier
    assert packing.pack(docs.limit(0)).collect() == []
