"""Keys stored and moved before md5 is taken of them."""

from pyspark.sql import functions as F

from conftest import SF
from tidemark.catalog.warehouse import Warehouse
from tidemark.functions import packed, plain_key, surrogate_key, unpacked

TEXTS = ["O0", "", None, "é" * 8, "a" * 14, "a" * 15, "a" * 16, "\1" + "a" * 14, "\1" + "a" * 15, "\2\1" + "a" * 13, "0" * 32, "\0" * 17]


def test_plain_keys_unpack_to_surrogate_keys_and_stay_apart(spark, rows):
    some = spark.createDataFrame([(t, n) for n, t in enumerate(TEXTS)], "t string, n int")
    plain = some.select("n", plain_key("t").alias("a_sk"), plain_key("t", "n").alias("b_sk"))
    assert rows(unpacked(plain)) == rows(some.select("n", surrogate_key("t").alias("a_sk"), surrogate_key("t", "n").alias("b_sk")))
    assert rows(packed(plain)) == rows(plain)
    assert plain.select("a_sk").distinct().count() == len(TEXTS) and plain.where("length(a_sk) = 16").count() == 0


def test_dimensions_and_facts_are_stored_without_digests(spark, rows):
    w = Warehouse(spark, SF)
    for name, key, natural in (("dim_product", "product_sk", "product_id"), ("fct_orders", "order_sk", "order_id"), ("fct_order_items", "order_item_sk", "item_id")):
        stored = w.keyed(name)
        assert stored.schema[key].dataType.typeName() == "binary"
        assert stored.where(F.length(key) > F.length(natural) + 2).isEmpty()
        assert rows(w.table(name).select(key, natural)) == rows(stored.select(surrogate_key(natural).alias(key), natural))
