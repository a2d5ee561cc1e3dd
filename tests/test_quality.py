import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import quality
from tidemark.plans import checks, observability
from tidemark.schemas import CONTRACTED_TABLES, contract


def test_contract_differences(spark):
    declared = T.StructType.fromDDL("a bigint, b string, c date")
    actual = T.StructType.fromDDL("b string, a int, d string")
    assert quality.contract_differences(actual, declared) == [
        "missing column c date", "undeclared column d string", "column a is int, declared bigint"
    ]
    with pytest.raises(quality.ContractError):
        quality.enforce_contract(spark.range(1), declared)
    kept = quality.enforce_contract(spark.sql("select 'x' b, 1L a, current_date() c"), declared)
    assert kept.columns == ["a", "b", "c"]
    assert len(CONTRACTED_TABLES) == 13 and contract("mart_returns")["return_count"].dataType == T.LongType()


def test_null_and_value_checks(spark):
    df = spark.createDataFrame([("a", None), (None, 1), ("z", 2), ("a", 3)], "s string, n int")
    assert {tuple(r) for r in quality.null_counts(df, "t", ["s", "n"]).collect()} == {("t", "s", 1), ("t", "n", 1)}
    assert [tuple(r) for r in quality.unaccepted_values(df, "s", ["a"]).collect()] == [("z", 1)]
    assert [tuple(r) for r in quality.not_unique(df, ["s"]).collect()] == [("a", 2)]
    assert quality.broken_grain(df.unionByName(df), ["s", "n"]).count() == 4
    rate = quality.null_rate(df, "s", 0.2).first()
    assert tuple(rate) == (4, 1, False)
    counted = quality.count_violations(df, {"x.y": F.col("n") > 1, "none": F.lit(False)})
    assert {tuple(r) for r in counted.collect()} == {("x.y", 2), ("none", 0)}


def test_checksum_ignores_order_but_not_content(spark):
    df = spark.range(50).selectExpr("cast(id as string) a", "if(id = 3, null, 'x') b")
    base = quality.table_checksum(df, ["a", "b"]).first()
    assert quality.table_checksum(df.orderBy(F.desc("a")).repartition(7), ["a", "b"]).first() == base
    blank = df.withColumn("b", F.coalesce("b", F.lit("")))
    assert quality.table_checksum(blank, ["a", "b"]).first() != base


def test_quarantine_threshold(spark):
    q = spark.range(3)
    assert tuple(checks.quarantine_threshold(q, 3).first()) == (3, False)
    assert checks.enforce_quarantine_threshold(q, 3).first()[0] == 3
    with pytest.raises(Exception, match="quarantine limit exceeded: 3"):
        checks.enforce_quarantine_threshold(q, 2).collect()


def test_volume_drift(spark):
    df = spark.createDataFrame([("s", f"b{i}") for i, n in enumerate((10, 10, 11, 50)) for _ in range(n)], "source string, batch string")
    got = {r.batch: r.drifted for r in quality.volume_drift(df, "source", "batch").collect()}
    assert got == {"b0": False, "b1": False, "b2": True, "b3": True}


def test_price_outliers(spark):
    items = spark.createDataFrame([("a", 0), ("b", 100), ("c", 100), ("d", 2001), ("e", 1_000_001), ("f", None)], "item_id string, unit_price_cents long")
    assert {r.item_id for r in checks.price_outliers(items).collect()} == {"a", "e"}
    assert {r.item_id for r in checks.price_outliers_by_median(items).collect()} == {"a", "d", "e"}


def test_freshness_grades(spark):
    counts = spark.sql("""select * from values ('a', timestamp_ntz'2026-01-09 12:00:00'), ('b', timestamp_ntz'2026-01-08 21:00:00'),
        ('c', timestamp_ntz'2026-01-01'), ('d', null) t(source_name, last_ingested_at)""")
    got = {r.source_name: r.status for r in observability.freshness(counts, "2026-01-10 00:00:00").collect()}
    assert got == {"a": "pass", "b": "warn", "c": "error", "d": "error"}


def test_failures_are_stored_per_run(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1)], "k string, n int")
    for run in ("r1", "r1", "r2"):
        checks.store_failures({"unique": rows, "none": rows.where("false")}, str(tmp_path / "f"), run)
    got = spark.read.parquet(str(tmp_path / "f")).collect()
    assert sorted((r.check_name, r.run_id, r.row_json) for r in got) == [("unique", "r1", '{"k":"a","n":1}'), ("unique", "r2", '{"k":"a","n":1}')]
