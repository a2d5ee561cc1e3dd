"""Quality: sums against direct least squares, isotonic fit, held-out results, odd input."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import quality, queries


def test_partition_sums_are_those_of_all_rows(spark):
    draw = np.random.default_rng(0)
    x, y, fold = draw.random((300, quality.STATISTICS)), draw.integers(0, 2, 300).astype(float), draw.integers(0, 4, 300)
    train = spark.createDataFrame([(a.tolist(), float(b), int(c)) for a, b, c in zip(x, y, fold)], "x array<double>, y double, fold int").repartition(7)
    fourier = quality.Fourier(x.mean(0), x.std(0), 20)
    gram, target = quality.normal_equations(train, fourier)
    for k in range(4):
        z = fourier(x[fold == k])
        assert np.allclose(gram[k], z.T @ z) and np.allclose(target[k], z.T @ y[fold == k])


def test_fourier_features_approximate_the_gaussian_kernel():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(40, quality.STATISTICS)) * 0.7
    z = quality.Fourier(np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS), 20_000)(x)[:, :-1]
    distance = ((x[:, None] - x[None]) ** 2).sum(2)
    assert np.abs(z @ z.T - np.exp(-distance / (4 * quality.STATISTICS))).max() < 0.05


def test_isotonic_pools_violators():
    at, value = quality.isotonic(np.arange(6.0), np.array([0, 1, 0, 1, 1, 1]), np.array([1, 1, 1, 1, 2, 1]))
    assert value.tolist() == sorted(value.tolist()) and np.allclose(value, [0, 0.5, 2 / 3, 1]) and np.allclose(at, [0, 1.5, 11 / 3, 5])


def test_held_out_results(spark):
    docs = queries.op1_quality(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out")
    right, all_, kept, good = docs.agg(
        F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count("*"), F.sum(F.col("predicted") * F.col("quality")), F.sum("quality")
    ).first()
    assert all_ > 50 and right >= 0.97 * all_ and kept >= 0.97 * good


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5.0), (2, "", 5.0), (None, "a b c", 5.0), (3, "x" * 200_000, 5.0), (3, "\n" * 9, 5.0), (4, "plain words here.", 5.0)], "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(1, 0), (4, 1), (4, 1), (3, None), (None, 1), (77, 1)], "doc_id bigint, quality int")
    rows = quality.score(spark, docs, labels, F.lit(True)).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert {r.score for r in quality.score(spark, docs, labels, F.lit(False)).collect()} == {0.5}
    assert quality.score(spark, docs.limit(0), labels, F.lit(True)).collect() == []


def test_statistics_are_of_one_length_and_bounded():
    for text in (None, "", " ", "a", "A" * 100_000, "#$%! " * 10, "é🙂\n" * 50):
        values = quality.statistics(text)
        assert len(values) == quality.STATISTICS and all(0 <= v <= 1.5 for v in values)
