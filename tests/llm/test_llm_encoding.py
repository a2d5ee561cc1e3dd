"""SentencePiece ids and texts as the public library gives them."""

import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import encoding, pieces

TEXTS = [None, "", " ", "   ", "  a", "a  b ", "▁x", "▁▁ ▁y", "\n", " \n", "\n ", "a\n\nb", "a \n b", "a\tb\x00c", "é🙂", "　a", "<s>", "</s>a<unk>", "<0x0A>", "x" * 4000, " " * 60 + "z", "word " * 30_000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())


def same(library, text):
    ids, decoded, n = pieces.loaded(pieces.default_path()).encode_text(text)
    want = library.encode(text)
    assert ids == ",".join(map(str, want)) and n == len(want) and decoded == library.decode(want)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text("abcdehinorst ▁\n.,é🙂0", max_size=40)))
def test_any_text(library, text):
    same(library, text)


def test_pieces_side_by_side(library):
    draw, normal = random.Random(1), [p for p, _, kind in pieces.read_pieces(pieces.default_path()) if kind == pieces.NORMAL]
    for _ in range(3000):
        same(library, "".join(draw.choice(normal) for _ in range(draw.randrange(9))).replace(pieces.MARK, " "))


def test_every_piece_is_found_or_split_as_in_the_library(library):
    for piece, _, kind in pieces.read_pieces(pieces.default_path())[::7]:
        if kind == pieces.NORMAL:
            same(library, piece.replace(pieces.MARK, " "))


def test_pairs_stay_as_all_merges_leave_them():
    model, draw = pieces.loaded(pieces.default_path()), random.Random(2)
    tokens = [p for p in model.ids if p in model.parts or len(p) == 1]
    near = {t[:k] for t in tokens for k in range(1, len(t))} & set(tokens)
    for _ in range(20_000):
        left, right = draw.choice(tokens), draw.choice(tokens)
        assert model.stays(left, right) == (model._merged(left + right) == [left, right])
    for left in draw.sample(sorted(near), 1500):
        for right in draw.sample(tokens, 3) + ["▁", "▁▁", "s", "e"]:
            assert model.stays(left, right) == (model._merged(left + right) == [left, right]), (left, right)


def test_columns(spark, library):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, IDS int")
    rows = encoding.encode(docs).collect()
    for r in rows:
        want = library.encode(r.text or "")
        assert r.ids == ",".join(map(str, want)) and r.n_tokens == len(want) and r.decoded == library.decode(want)
    back = encoding.decode(encoding.encode(docs).select("doc_id", "ids")).collect()
    assert {r.doc_id: r.text for r in back} == {i: library.decode(library.encode(t or "")) for i, t in enumerate(TEXTS)}
    assert encoding.encode(docs.limit(0)).collect() == []


def test_given_texts_and_a_full_cache(spark, library, monkeypatch):
    monkeypatch.setattr(pieces, "_CACHED_SEGMENTS", 50)
    monkeypatch.setattr(pieces, "_CACHED_PAIRS", 50)
    model = pieces.PieceModel(pieces.default_path())
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        assert model.encode(r.text) == library.encode(r.text)
    assert len(model.cache) <= 50 and model.pairs <= 50
