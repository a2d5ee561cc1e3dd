"""I-Match: edited texts by hand, the lexicon's band, likeness, equal texts, odd input."""

import hashlib
import random

from pyspark.sql import functions as F

from tidemark.llm import imatch, queries


def plain_edit(texts):
    ids = sorted(i for i in texts if i is not None)
    out = {}
    for i, text in texts.items():
        following = texts[ids[(ids.index(i) + 1) % len(ids)]] if i is not None else None
        half = len(text or "") // 2
        out[i] = (text or "")[: len(text or "") - half] + (following or "")[:half]
    return out


def words(draw, n):
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(4)) for _ in range(n))


def test_edited_texts_and_likeness(spark):
    draw = random.Random(2)
    texts = {i * 7 - 50: words(draw, draw.randrange(80)) for i in range(40)} | {1000: None, 1001: "", 2000: "é🙂x", 2001: "!?", None: "no id", 3000: "long " * 30_000}
    docs = spark.createDataFrame([(i, t, "own") for i, t in texts.items()], "doc_id bigint, text string, fingerprint string").repartition(5)
    rows = {r.doc_id: r for r in imatch.compare_edits(docs).collect()}
    assert set(rows) == set(texts)
    for i, edited in plain_edit(texts).items():
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and rows[i].n_chars == len(texts[i] or "")
    ids = sorted(i for i in texts if i is not None)
    for a, b in zip(ids, ids[1:] + ids[:1]):
        mine, other, edit = (r.split(".") for r in (rows[a].fingerprint, rows[b].fingerprint, rows[a].edited_fingerprint))
        for score, theirs in ((rows[a].near_next, other), (rows[a].near_edited, edit)):
            met = [(x, y) for x, y in zip(mine, theirs) if x or y]
            assert abs(score - sum(x == y for x, y in met) / len(met)) < 1e-12
    assert rows[1000].near_next == 1 and rows[1000].near_edited == 1 and rows[None].near_next == 0


def test_terms_outside_the_band_do_not_matter(spark):
    draw = random.Random(4)
    band = [f"term{k}" for k in range(20)]
    texts = [" ".join(["common", *draw.sample(band, 8), f"rare{i}"]) for i in range(100)]
    texts += [texts[0].replace("rare0", "rare0b") + " common", texts[0].upper()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: r for r in imatch.compare_edits(docs, band=(0.05, 0.6)).collect()}
    assert rows[0].fingerprint == rows[100].fingerprint == rows[101].fingerprint and rows[100].near_next == 1.0
    assert len({r.fingerprint for r in rows.values()}) > 95
    assert rows[0].near_next < 1


def test_copies_do_not_take_their_terms_out_of_the_lexicon(spark):
    draw = random.Random(6)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = [" ".join(draw.sample(vocabulary, 25)) for _ in range(200)]
    rows = texts + [texts[0]] * 100  # a third of the rows are copies
    draw.shuffle(rows)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)] + [(1000 + i, t) for i, t in enumerate(texts[1:6])], "doc_id bigint, text string").repartition(4)
    found = imatch.compare_edits(docs).join(docs, "doc_id").collect()
    copies = [r for r in found if r.text == texts[0]]
    others = [r for r in found if r.text != texts[0]]
    mean = lambda rows, name: sum(r[name] for r in rows) / len(rows)
    assert len({r.fingerprint for r in copies}) == 1 and len(copies) == 101
    unlike = [r for r in copies if r.near_next < 1]
    assert mean(unlike, "near_edited") > 0.6 * mean(others, "near_edited") > 2 * mean(unlike, "near_next")
    # The lexicon is the one of the texts without their copies.
    once = spark.createDataFrame([(t,) for t in texts], "text string")
    bitmap = lambda df: df.sparkSession.range(1).select(imatch.lexicon(df)).first()[0]
    assert bitmap(docs) == bitmap(once)


def test_small_edits_are_nearer_than_other_texts(spark):
    rows = queries.op3_imatch(spark, "/root/testdata/sf0.001").agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert rows[0] > rows[1] + 0.05


def test_repeated_rows_single_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(5, "b b"), (5, "a a a a"), (5, "b b"), (9, "c")], "doc_id bigint, text string")
    rows = imatch.compare_edits(docs).collect()
    assert sorted(r.n_chars for r in rows) == [1, 3, 3, 7]
    assert {r.edited_sha256 for r in rows if r.n_chars == 3} == {hashlib.sha256(b"b c").hexdigest()}
    alone = imatch.compare_edits(docs.where("doc_id = 9")).first()
    assert alone.near_next == 1.0 and imatch.compare_edits(docs.limit(0)).collect() == []


def test_no_python_runs_on_executors(spark):
    plan = queries.op3_imatch(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
