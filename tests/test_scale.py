"""Plan shapes that matter at scale, and results with one key holding a third of all rows."""

import contextlib
import re
import time

import pytest
from conftest import SF
from pyspark.sql import functions as F

from tidemark.catalog.inputs import Inputs
from tidemark.catalog.queries import registered
from tidemark.operators import dedup, intake, joins
from tidemark.plans import checks, core, marts
from tidemark.session import INPUT_PARTITIONS, dealt_out, fit_to_input, shared_dir
from tidemark.sources import relational


@contextlib.contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


TIGHT = {
    "spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    "spark__sql__adaptive__forceOptimizeSkewedJoin": "true",
}


def hot(spark, n=30000):
    """Facts in eight input partitions, a third of them for customer C0 and order O0."""
    return spark.range(0, n, 1, 8).select(
        F.concat(F.lit("I"), "id").alias("order_item_sk"),
        F.when(F.col("id") % 3 == 0, "C0").otherwise(F.concat(F.lit("C"), F.col("id") % 997)).alias("customer_id"),
        F.when(F.col("id") % 3 == 0, "O0").otherwise(F.concat(F.lit("O"), F.col("id") % 9973)).alias("order_sk"),
        F.concat(F.lit("P"), F.col("id") % 101).alias("product_sk"),
        F.lit("2024-06-01").cast("timestamp_ntz").alias("order_ts"),
        (F.col("id") % 5 + 1).alias("quantity"), F.lit(100).cast("long").alias("unit_price_cents"),
        ((F.col("id") % 5 + 1) * 100).alias("line_amount_cents"), F.md5(F.col("id").cast("string")).alias("pad"),
    )


def versions(spark):
    return spark.range(997).select(
        F.concat(F.lit("C"), "id").alias("customer_id"), F.md5(F.col("id").cast("string")).alias("customer_sk"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("dbt_valid_from"), F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
    )


def test_hot_customer_is_split_in_the_as_of_join(spark):
    def build():
        return joins.as_of(hot(spark), versions(spark), "customer_id", "order_ts")

    plain = build().agg(F.count("*"), F.sum("quantity")).first()
    with settings(spark, **TIGHT):
        df = build()
        assert "SortMergeJoin(skew=true)" in executed(df)
        assert df.agg(F.count("*"), F.sum("quantity")).first() == plain
    assert plain[0] == 30000


@pytest.mark.parametrize("check", ["flag", "missing", "versions"])
def test_hot_customer_is_split_against_distinct_keys(spark, check):
    facts, known = hot(spark).withColumn("order_id", F.col("order_item_sk")), versions(spark).unionByName(versions(spark))
    build = {
        "flag": lambda: intake.flag_known_keys(facts, "customer_id", known.where("customer_id <> 'C0'"), "customer_id", "known").where("not known"),
        "missing": lambda: joins.without_match(facts, "customer_id", known.where("customer_id <> 'C0'"), "customer_id"),
        "versions": lambda: checks.not_one_version(
            facts.withColumn("customer_sk", F.col("customer_id")), known.withColumn("customer_sk", F.col("customer_id"))
        ),
    }[check]
    with settings(spark, **TIGHT):
        df = build()
        assert "skew=true" in executed(df)
        assert df.count() == (30000 if check == "versions" else facts.where("customer_id = 'C0'").count())


def test_hot_order_is_split_before_the_product_totals(spark):
    orders = spark.range(9973).select(F.concat(F.lit("O"), "id").alias("order_sk"), F.lit("shipped").alias("status"))
    items = hot(spark)
    plain = {tuple(r) for r in marts.product_totals(items, orders).collect()}
    with settings(spark, **TIGHT):
        df = marts.product_totals(items, orders)
        assert "skew=true" in executed(df)
        assert {tuple(r) for r in df.collect()} == plain
    assert sum(r[1] for r in plain) == 90000


def test_rows_without_key_do_not_meet_in_one_task(spark):
    rows = spark.range(0, 9000, 1, 4).select(F.when(F.col("id") % 3 > 0, F.concat(F.lit("C"), F.col("id") % 10)).alias("customer_id"), "id")
    flagged = intake.flag_known_keys(rows, "customer_id", versions(spark), "customer_id", "known")
    with settings(spark, **{k: v for k, v in TIGHT.items() if "Broadcast" in k}, spark__sql__adaptive__enabled="false"):
        sizes = [len(p) for p in flagged.where("customer_id is null").rdd.glom().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1500
    assert flagged.where("known").count() == 6000


def test_children_are_aggregated_before_they_are_joined(spark):
    returns = hot(spark).select("order_item_sk", "quantity", F.lit("damaged").alias("reason"), F.col("order_ts").alias("returned_at"))
    doubled = returns.unionByName(returns.where("order_item_sk = 'I3'"))
    got = marts.int_return_metrics(hot(spark), doubled)
    assert got.count() == 30000
    assert got.where("order_item_sk = 'I3'").select("returned_quantity").first()[0] == 8


def test_filters_and_columns_reach_the_scan(spark):
    orders = Inputs(spark, SF).table("orders")
    plan = executed(relational.increment(orders, ["o_orderkey", "o_orderdate"], "o_orderdate", F.lit("1999-01-01").cast("timestamp_ntz")))
    assert "GreaterThan(o_orderdate" in plan and "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


@pytest.mark.parametrize("name", [
    "mart_sales", "mart_customer_retention", "mart_product_performance", "mart_returns", "mart_inventory", "scd2_snapshot",
    "fct_orders", "int_return_metrics", "bq05_cohorts", "bq06_rank_movement", "dq_price_outlier_median", "scd2_violations",
])
def test_no_cross_joins_and_no_python(spark, name):
    plan = executed(registered()[name](spark, SF))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEvalPython|MapInPandas", plan)


def test_sales_mart_scans_each_table_once(spark):
    plan = executed(registered()["mart_sales"](spark, SF)).split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 7


def test_dimension_is_not_broadcast_beyond_the_threshold(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="1KB", spark__sql__adaptive__autoBroadcastJoinThreshold="1KB"):
        assert "BroadcastHashJoin" not in executed(joins.as_of(hot(spark), versions(spark), "customer_id", "order_ts"))


def sparse_table(folder, gigabytes):
    folder.mkdir(parents=True)
    with open(folder / "big", "wb") as f:
        f.truncate(gigabytes << 30)


def test_shuffles_fit_the_largest_table_of_each_folder(spark, tmp_path):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    for name, gigabytes in (("first", 1), ("second", 1000)):
        for table in ("a", "b"):
            sparse_table(tmp_path / name / table, gigabytes)
    with settings(spark, spark__sql__shuffle__partitions="1"):
        for name, partitions in (("first", "24"), ("second", "24000"), ("first", "24")):
            fit_to_input(spark, str(tmp_path / name))
            assert spark.conf.get(key) == partitions
    with settings(spark, spark__sql__shuffle__partitions="100"):
        fit_to_input(spark, str(tmp_path / "first"))
        assert spark.conf.get(key, None) is None
    with settings(spark, **{key.replace(".", "__"): "7"}):
        fit_to_input(spark, str(tmp_path / "second"))
        assert spark.conf.get(key) == "7"


def test_tasks_read_no_more_than_they_can_sort_unless_the_caller_says_so(spark, tmp_path):
    sparse_table(tmp_path / "t", 1)
    key = "spark.sql.files.maxPartitionBytes"
    for given, read in ((None, "32m"), ("64m", "64m")):
        session = spark.newSession()
        if given:
            session.conf.set(key, given)
        fit_to_input(session, str(tmp_path))
        assert session.conf.get(key) == read


def test_merged_shuffle_partitions_stay_small_unless_the_caller_says_so(spark, tmp_path):
    sparse_table(tmp_path / "t", 1)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    for given, merged in ((None, "32m"), ("64m", "64m")):
        session = spark.newSession()
        if given:
            session.conf.set(key, given)
        fit_to_input(session, str(tmp_path))
        assert session.conf.get(key) == merged


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if f.endswith(".data") and "/shuffle_" in f}


def test_shuffle_files_go_with_the_action_that_wrote_them(spark, rows, tmp_path):
    sparse_table(tmp_path / "t", 1)
    for given in (None, "false"):
        session = spark.newSession()
        if given:
            session.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", given)
        fit_to_input(session, str(tmp_path))
        before = shuffle_files(spark)
        counted = session.range(1000).groupBy((F.col("id") % 3).alias("k")).count()
        found = rows(counted)
        until = time.time() + 20
        while given is None and shuffle_files(spark) - before and time.time() < until:
            time.sleep(0.2)
        assert bool(shuffle_files(spark) - before) == (given == "false")
        assert rows(counted) == found == [(0, 334), (1, 333), (2, 333)]  # and are written again for the same frame


def test_inputs_are_dealt_out_only_on_request(spark):
    scan = spark.range(10)
    assert dealt_out(spark, scan) is scan
    with settings(spark, **{INPUT_PARTITIONS.replace(".", "__"): "3"}):
        assert dealt_out(spark, scan).rdd.getNumPartitions() == 3


def test_a_cluster_needs_a_shared_folder():
    class Context:
        applicationId, master = "cluster-app", "spark://host:7077"

    class Session:
        sparkContext = Context

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session)


def test_keys_of_an_increment_do_not_move_history(spark, tmp_path):
    spark.range(200_000).select((F.col("id") % 50_000).cast("string").alias("k")).write.parquet(str(tmp_path / "old"))
    spark.range(49_990, 50_010).select(F.col("id").cast("string").alias("k")).write.parquet(str(tmp_path / "new"))

    def stage(df):
        df.write.parquet(str(tmp_path / "staged"))
        return spark.read.parquet(str(tmp_path / "staged"))

    found = dedup.duplicates_vs_existing(spark.read.parquet(str(tmp_path / "new")), spark.read.parquet(str(tmp_path / "old")), ["k"], stage)
    plan = executed(found)
    assert found.first()[0] == 10 and "SortMergeJoin" not in plan


def test_relational_scans_without_bounds_are_refused():
    for split, bounds in ((None, (1, 2)), ("id", None), ("id", (1, None))):
        with pytest.raises(ValueError, match="bound"):
            relational.jdbc_options("jdbc:x", "t", split, bounds)
    assert relational.jdbc_options("jdbc:x", "t", "id", (1, 9))["numPartitions"] == "16"


def test_new_raw_data_reaches_every_table(spark, tmp_path):
    for table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        spark.read.parquet(f"{SF}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    build = registered()["mart_sales"]
    before = build(spark, str(tmp_path))
    rows_before = before.count()
    orders = spark.read.parquet(f"{SF}/orders.parquet").where("o_orderstatus = 'F'").orderBy("o_orderkey").limit(50)
    # What is sold of the copies is what is sold of the originals.
    sold = before.join(orders.select(F.col("o_orderkey").cast("string").alias("order_id")), "order_id", "left_semi").count()
    orders.withColumn("o_orderkey", F.col("o_orderkey") + 90_000_000).write.mode("append").parquet(str(tmp_path / "orders.parquet"))
    assert sold > 0 and build(spark, str(tmp_path)).count() == rows_before + sold


def test_calendar_covers_whole_years(spark):
    bounds = core.calendar_bounds((spark.sql("select timestamp_ntz'1996-05-05' t"), "t"), (spark.sql("select timestamp_ntz'1998-02-01' t"), "t"))
    assert [str(v) for v in bounds.first()] == ["1996-01-01", "1998-12-31"]
