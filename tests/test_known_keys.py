"""Duplicates against history from its key index, and ranges of equal depth."""

import random

from pyspark.sql import functions as F

from tidemark.operators import dedup
from tidemark.sources import relational
from tidemark.sources.known_keys import KnownKeys


def batch(spark, name, keys):
    return spark.createDataFrame([(name, *k) for k in keys], "_batch_id string, a long, b string")


def test_only_batches_that_may_hold_a_key_are_opened(spark, tmp_path):
    known = KnownKeys(spark, str(tmp_path / "known"), ("a", "b"))
    assert known.duplicates(batch(spark, "n", [(1, "x")])).collect()[0][0] == 0
    history = batch(spark, "b0", [(k, "x") for k in range(400)])
    for n in range(1, 6):
        history = history.unionByName(batch(spark, f"b{n}", [(1000 * n + k, "x") for k in range(400)] + ([(None, None), (None, "y")] if n == 2 else [])))
    known.add(history)
    new = batch(spark, "n", [(7, "x"), (7, "x"), (7, "y"), (2001, "x"), (None, None), (None, "z"), (5, None)])
    want = dedup.duplicates_vs_existing(new, history, ["a", "b"]).first()[0]
    assert want == 4

    opened = {r[0] for r in known.may_be_known(new).select("_batch_id").distinct().collect()}
    assert {"b0", "b2"} <= opened and len(opened) <= 4
    for part in known.table.parts().where(~F.col("value").isin(*opened)).collect():
        for file in (tmp_path / "known" / part.folder).glob("*.parquet"):
            file.write_bytes(b"rubbish")
    assert known.duplicates(new).first()[0] == want


def test_a_batch_that_runs_again_replaces_its_keys(spark, tmp_path, rows):
    known = KnownKeys(spark, str(tmp_path / "known"), ("a",))
    known.add(batch(spark, "b1", [(1, ""), (2, ""), (2, "")]))
    known.add(batch(spark, "b2", [(3, "")]))
    known.add(batch(spark, "b1", [(2, ""), (4, "")]))
    known.add(batch(spark, "b1", []))
    assert rows(known.table.read()) == [("b1", 2), ("b1", 4), ("b2", 3)]
    new = batch(spark, "b1", [(1, ""), (2, ""), (3, ""), (4, "")])
    assert known.duplicates(new).first()[0] == 3 and known.duplicates(new, "b1").first()[0] == 1


def test_ranges_hold_each_row_once_and_are_alike(spark):
    rng = random.Random(2)
    values = [int(rng.lognormvariate(8, 2)) * 7 for _ in range(5000)] + [None] * 20
    df = spark.createDataFrame([(v,) for v in values], "k long")
    bounds = relational.equal_depth_bounds(df, "k", 8)
    later = df.unionByName(spark.createDataFrame([(-5,), (10**12,), (bounds[3],)], "k long"))
    sizes = later.agg(*(F.count_if(F.expr(p)) for p in relational.range_predicates("k", bounds))).first()
    assert len(sizes) == 8 and sum(sizes) == 5023 and max(sizes) < 2 * min(sizes)


def test_ranges_of_one_value_of_none_and_of_no_rows(spark):
    one = spark.createDataFrame([(3,)] * 50, "k long")
    assert relational.range_predicates("k", relational.equal_depth_bounds(one, "k", 4)) == ["k <= 3 or k is null", "k > 3"]
    assert relational.equal_depth_bounds(one.limit(0), "k", 4) == [] and relational.equal_depth_bounds(one, "k", 1) == []
    assert relational.equal_depth_bounds(spark.sql("select cast(null as bigint) k"), "k", 4) == []
    assert relational.range_predicates("k", []) == ["1 = 1"]


def test_ranges_of_a_decimal_wider_than_bigint(spark):
    key = F.col("id").cast("decimal(19,0)")
    cubes = spark.range(8_000_000, 9_000_000, 200, 4).select((key * F.col("id") * F.col("id")).cast("decimal(38,0)").alias("k"))
    bounds = relational.equal_depth_bounds(cubes, "k", 8)
    sizes = cubes.agg(*(F.count_if(F.expr(p)) for p in relational.range_predicates("k", bounds))).first()
    assert bounds[0] > 2**63 and len(sizes) == 8 and sum(sizes) == 5000 and max(sizes) < 2 * min(sizes)
