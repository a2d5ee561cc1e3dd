"""Language: sums over segmentations against enumeration, held-out accuracy, odd input."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language, pieces, queries


@pytest.fixture(scope="module")
def model():
    return pieces.loaded(pieces.default_path())


@pytest.fixture(scope="module")
def sums(model):
    draw = np.random.default_rng(3)
    probabilities = draw.random((3, len(model.pieces)))
    return language.Segmentations(model, probabilities / probabilities.sum(1, keepdims=True))


def enumerate_sum(sums, word, lang):
    """Plain recursion over all segmentations, and the expected use of each piece."""
    total, used = 0.0, {}

    def walk(at, weight, path):
        nonlocal total
        if at == len(word):
            total += weight
            for p in path:
                used[p] = used.get(p, 0.0) + weight
            return
        if word[at] not in sums.model.ids:
            walk(at + 1, weight * language._UNKNOWN, path)
        for end in range(at + 1, len(word) + 1):
            piece = sums.model.ids.get(word[at:end])
            if piece is not None:
                walk(end, weight * sums.scaled[piece, lang] / language._PER_CHARACTER ** (end - at), [*path, piece])

    walk(0, 1.0, [])
    return total, {p: v / total for p, v in used.items()}


@pytest.mark.parametrize("word", ["▁the", "▁interest", "a", "\n", "▁é🙂x", "🙂🙂", "▁▁▁on", "nation,"])
def test_all_segmentations_count(sums, word):
    for lang in range(3):
        total, used = enumerate_sum(sums, word, lang)
        assert math.isclose(sums.forward(word)[1][lang], math.log(total), rel_tol=1e-9, abs_tol=1e-9)
        expected = sums.expected(word, lang)
        assert set(expected) == set(used) and all(math.isclose(expected[p], used[p], rel_tol=1e-9) for p in used)


def test_long_words_stay_in_range(sums):
    assert np.isfinite(sums.forward("x" * 20_000)[1]).all() and np.isfinite(sums.forward("🙂é" * 5000)[1]).all()
    short, long = (sums.forward("▁" + "tion" * n)[1] for n in (10, 20))
    longer = sums.forward("▁" + "tion" * 30)[1]
    assert np.allclose(longer - long, long - short, rtol=1e-2)


@pytest.mark.parametrize("n", [1, 24, 25, 48, 49, 57, 64, 65, 130, 5000])
def test_runs_outside_the_vocabulary_stay_in_range(model, sums, n):
    each = math.log(language._UNKNOWN)
    assert "\ue000" not in model.ids
    assert np.allclose(sums.forward("\ue000" * n)[1], n * each, rtol=1e-9)
    assert np.allclose(sums.logs_of([["\ue000" * n]])[0], n * each, rtol=1e-9)
    word = "▁the" + "\ue000" * n + "nation"
    alone = sums.forward("▁the")[1] + sums.forward("nation")[1]
    assert np.allclose(sums.forward(word)[1], alone + n * each, rtol=1e-9)
    for lang in range(3):
        parts = sums.expected("▁the", lang) + sums.expected("nation", lang)
        used = sums.expected(word, lang)
        assert set(used) == set(parts) and all(math.isclose(used[p], parts[p], rel_tol=1e-7) for p in used)
    # Known characters that a large sample has not seen weigh less than unknown ones.
    rare = language.Segmentations(model, np.full((2, len(model.pieces)), 1e-12))
    han = "".join(sorted(c for c in rare.characters if "\u4e00" <= c <= "\u9fff"))[:40] * (n // 40 + 1)
    assert np.isfinite(rare.forward(han[:n])[1]).all() and np.isfinite(rare.logs_of([[han[:n]]])).all()
    assert all(math.isfinite(k) for k in rare.expected(han[:n], 0).values()) and sum(rare.expected(han[:n], 0).values()) > 0


def test_stretches_do_not_change_sums(sums, monkeypatch):
    words = ["▁" + "tion" * 10 + "é🙂x" * 8 + "nation,", "▁internationalisation" * 2, "x" * 130]
    have = [(sums.forward(w)[1], sums.expected(w, 1)) for w in words]
    many = sums.forward_many([w[:48] for w in words])
    monkeypatch.setattr(language, "_STRETCH", 1000)
    plain = sums.forward_many([w[:48] for w in words])
    assert np.allclose(many, plain, rtol=1e-9)
    for word, (logs, used) in zip(words, have):
        assert np.allclose(logs, sums.forward(word)[1], rtol=1e-9)
        want = sums.expected(word, 1)
        assert set(used) == set(want) and all(math.isclose(used[p], want[p], rel_tol=1e-7) for p in used)


def test_a_run_of_unknown_characters_leaves_the_other_words_their_say(spark):
    taught = [(1, "the cat sat on the mat and the dog", "en"), (2, "der hund und die katze sind im haus", "de")]
    runs = ["\ue000" * n for n in (57, 64, 65, 5000)]
    rows = taught + [(10 + k, f"{run} der hund und die katze", "de") for k, run in enumerate(runs)] + [(20 + k, f"the dog and the cat {run}", None) for k, run in enumerate(runs)]
    out = language.identify(spark, spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), F.lit(True)).collect()
    assert all(r.lang_pred == ("en" if r.doc_id in (1, 20, 21, 22, 23) else "de") and 0.5 < r.score <= 1 for r in out)


def test_words_add_up_whether_cached_or_not(model, sums, monkeypatch):
    monkeypatch.setattr(language, "_CACHED_WORDS", 4)
    monkeypatch.setattr(language, "_GROUP_NEW", 3)
    few = language.Segmentations(model, np.ones((3, len(model.pieces))) / len(model.pieces))
    few.scaled = sums.scaled
    texts = [[" a", " b", " a", "\nc"], [" d" + "e" * 60, " e", " f", " a", "\nc", "🙂é"], [], [" the"], [f" w{k}" for k in range(9)]]
    want = [sum((sums.forward(w.replace(" ", pieces.MARK))[1] for w in words), np.zeros(3)) for words in texts]
    for _ in range(3):
        assert np.allclose(few.logs_of(texts), want)
        assert np.allclose(few.logs_of(texts[::-1]), want[::-1])


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = queries.op7_language(spark, "/root/testdata/sf0.001").join(docs, "doc_id").where("held_out and lang is not null")
    right, all_ = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert all_ > 20 and right >= 0.97 * all_


def test_odd_rows(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "12 34 !?", "de"), (5, "", None), (None, "the dog", None), (6, "die maus", None), (6, "die maus", None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, lang string, score string")
    out = [(r.doc_id, r.lang_pred) for r in language.identify(spark, docs, F.lit(True)).collect()]
    assert sorted(out, key=repr) == sorted([(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (None, "en"), (6, "de"), (6, "de")], key=repr)
    assert {r.lang_pred for r in language.identify(spark, docs, F.lit(False)).collect()} == {"und"}
    assert language.identify(spark, docs.limit(0), F.lit(True)).collect() == []
