import random
import statistics

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import ranking


def values(seed, n=2000):
    rng = random.Random(seed)
    kinds = (lambda: 0, lambda: rng.randint(-50, 50), lambda: rng.randint(-10**15, 10**15), lambda: 7)
    return [rng.choice(kinds)() for _ in range(n)]


@pytest.mark.parametrize("seed,descending", [(1, True), (2, False)])
def test_rank_equals_window_rank(spark, seed, descending):
    data = pd.DataFrame({"v": values(seed), "g": [i % 3 for i in range(2000)]})
    got = ranking.with_rank(spark.createDataFrame(data), "v", "r", descending).toPandas().sort_values(["v", "r"])
    expected = got["v"].rank(method="min", ascending=not descending).astype(int)
    assert (got["r"] == expected).all() and len(got) == 2000
    by = ranking.with_rank(spark.createDataFrame(data), "v", "r", descending, by=("g",)).toPandas()
    assert (by["r"] == by.groupby("g")["v"].rank(method="min", ascending=not descending).astype(int)).all()


def test_nulls_rank_last(spark):
    df = spark.createDataFrame([(5,), (None,), (9,), (None,)], "v long")
    assert sorted((r.v is None, r.r) for r in ranking.with_rank(df, "v", "r").collect()) == [
        (False, 1), (False, 2), (True, 3), (True, 3)
    ]


def test_bands_are_monotone(spark):
    points = sorted({s * (2**e + d) for e in range(0, 62, 3) for d in (-1, 0, 1, 5) for s in (1, -1)})
    df = spark.createDataFrame([(p,) for p in points], "v long")
    bands = [r.b for r in df.select("v", ranking.value_band(F.col("v")).alias("b")).orderBy("v").collect()]
    assert bands == sorted(bands)


@pytest.mark.parametrize("seed,n", [(3, 1001), (4, 1000), (5, 1), (6, 2)])
def test_median_is_exact(spark, seed, n):
    data = values(seed, n)
    df = spark.createDataFrame([(v,) for v in data] + [(None,)], "v long")
    assert ranking.exact_median(df, "v").first()[0] == statistics.median(data)


@pytest.mark.parametrize("values", ["10_000_000_000_000 + id", "-1000000000000 - id * 3", "id * id * id * 1000", "9223372036854775807 - id", "case when id % 2 = 0 then 5 else 1000000000000 + id end"])
def test_clustered_values_are_spread_and_ranked_exactly(spark, values):
    rows = spark.range(20_000).selectExpr("id", f"cast({values.replace('_', '')} as bigint) v")
    got = ranking.with_rank(rows, "v", "r")
    assert got.join(rows.selectExpr("id", "rank() over (order by v desc) want"), "id").where("r <> want").count() == 0
    band = ranking.value_band(F.col("v"))
    ends = rows.select("v", band.alias("b")).groupBy("b").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    slices = rows.select("v", band.alias("b")).distinct().join(ends, "b").groupBy("b", ranking.value_slice(F.col("v"), F.col("lo"), F.col("hi"))).count()
    assert slices.agg(F.max("count")).first()[0] <= 200
