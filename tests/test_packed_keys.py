"""Surrogate keys packed for exchanges, and what is moved with them."""

from pyspark.sql import functions as F

from tidemark.functions import packed, unpacked
from tidemark.sources.tables import ManifestTable

TEXTS = ["O0", "", None, "é" * 16, "0" * 32, "A" * 32, "a" * 32, "z" * 32, "a" * 31, "a" * 33, "\0" * 17, "\0" * 16]


def keys(spark):
    return spark.createDataFrame([(n, t, t) for n, t in enumerate(TEXTS)], "n int, order_sk string, name string")


def test_packed_keys_come_back_as_they_were_and_stay_apart(spark, rows):
    some = keys(spark).unionByName(spark.range(50).select(F.col("id").cast("int").alias("n"), F.md5(F.col("id").cast("string")).alias("order_sk"), F.lit("x").alias("name")))
    short = packed(some)
    assert rows(unpacked(short)) == rows(some) and unpacked(short).schema["order_sk"].dataType == some.schema["order_sk"].dataType
    assert short.select("order_sk").distinct().count() == some.select("order_sk").distinct().count()
    assert short.where("n >= 0 and length(order_sk) = 16").count() == 52 and short.schema["name"].dataType.typeName() == "string"
    assert rows(packed(short)) == rows(short)


def test_a_binary_column_of_a_stored_table_stays_binary(spark, rows, tmp_path):
    table = ManifestTable(spark, str(tmp_path / "t"), ("order_sk",), ("day",), indexed=("order_sk",))
    first = keys(spark).where("order_sk is not null").select("order_sk", F.encode("name", "utf-8").alias("raw_sk"), F.lit("a").alias("day"))
    table.merge(first)
    later = first.where("order_sk in ('O0', '')").withColumn("day", F.lit("b"))
    table.merge(later)
    assert table.read().schema["raw_sk"].dataType.typeName() == "binary"
    expected = first.where("order_sk not in ('O0', '')").unionByName(later)
    assert rows(table.read()) == rows(expected)
    found = table.lookup("order_sk", spark.createDataFrame([("O0",), ("a" * 32,)], "v string"))
    assert rows(found) == rows(expected.where("order_sk in ('O0', repeat('a', 32))"))


def test_narrow_changes_are_those_of_whole_rows(spark, rows, tmp_path):
    table = ManifestTable(spark, str(tmp_path / "t"), ("order_sk",), ("day",))
    table.merge(spark.createDataFrame([("a", 1, None, "x"), ("b", None, 1, "x"), ("c", 3, 3, "y")], "order_sk string, p int, q int, day string"))
    table.merge(spark.createDataFrame([("a", None, 1, "x"), ("d", 4, 4, "x")], "order_sk string, p int, q int, day string"))
    assert rows(table.changes(1, 2, ["order_sk"])) == rows(table.changes(1, 2).select("order_sk", "is_new")) == [("a", False), ("a", True), ("d", True)]


def test_a_first_merge_leaves_no_copy_of_its_source(spark, tmp_path):
    table = ManifestTable(spark, str(tmp_path / "t"), ("k",), ("day",))
    assert table.merge(spark.createDataFrame([], "k int, day string")) == 0 and not table.exists()
    assert table.merge(spark.createDataFrame([(1, "x"), (2, "y")], "k int, day string")) == 2
    assert not list((tmp_path / "t").rglob("sources"))
