"""The given tables seen as the eight raw sources.

Every raw view covers its whole table. Column expressions add the defects the pipeline must cope with:
padded text, blank and shared emails, unknown customers, replayed and corrected orders, superseded payment
states, free and absurd prices, casing variants, a second inventory reading, broken JSON lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.intake import stamp_metadata
from tidemark.schemas import SOURCES
from tidemark.session import dealt_out

# Run times of the two customer snapshots, and "now" for age checks.
FIRST_SNAPSHOT = "1995-01-01 00:00:00"
SECOND_SNAPSHOT = "2000-01-01 00:00:00"
NOW = "2001-12-01 00:00:00"


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def _spread(self, name: str) -> DataFrame:
        """For row-wise heavy work; a plain aggregate is faster on the scan as it is."""
        return dealt_out(self.spark, self.table(name))

    def raw(self, source: str) -> DataFrame:
        return getattr(self, f"_{source}")()

    # Two snapshots of the customer file: the second moves one segment and lacks closed accounts.

    def _customers(self) -> DataFrame:
        return self._customer_file(moved=F.lit(False), batch="1995-01-01", at="1995-01-01 02:00:00")

    def customers_second(self) -> DataFrame:
        moved = F.col("c_mktsegment") == "HOUSEHOLD"
        rows = self._customer_file(moved, batch="2000-01-01", at="2000-01-01 02:00:00", closed=True)
        return rows

    def _customer_file(self, moved: Column, batch: str, at: str, closed: bool = False) -> DataFrame:
        customers = self.table("customer")
        if closed:
            customers = customers.where(F.col("c_acctbal") >= -900)
        key = F.col("c_custkey")
        text = key.cast("string")
        email = (
            F.when(key % 33 == 0, F.lit("  "))
            .when(key % 300 == 7, F.lit("user1@example.com"))
            .otherwise(F.concat(F.lit(" USER"), text, F.lit("@Example.com ")))
        )
        joined = F.lit("1995-01-01 08:00:00").cast("timestamp_ntz") + F.make_dt_interval((key % 180).cast("int"))
        updated = F.when(moved, joined + F.make_dt_interval(F.lit(900))).otherwise(joined)
        city = F.concat(F.lit(" City-"), (key % 400).cast("string"))
        rows = customers.select(
            text.alias("customer_id"),
            F.lit(" Customer").alias("first_name"),
            F.substring("c_name", 10, 20).alias("last_name"),
            email.alias("email"),
            F.when(moved, F.concat(F.lit("Moved-"), F.trim(city))).otherwise(city).alias("city"),
            F.when(moved, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey")).cast("string").alias("region_id"),
            F.when(F.col("c_mktsegment").isin("MACHINERY", "BUILDING"), "corporate").otherwise("consumer").alias("segment"),
            joined.cast("date").cast("string").alias("signup_date"),
            updated.cast("string").alias("updated_at"),
            (key + 2).alias("_row"),
        )
        return stamp_metadata(rows, SOURCES["customers"], batch, at, "_row")

    def _regions(self) -> DataFrame:
        region = self.table("region")
        rows = self.table("nation").join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").cast("string").alias("region_id"),
            F.concat(F.lit("  "), F.col("r_name"), F.lit(" ")).alias("region_name"),
            F.col("n_name").alias("country"),
            (F.col("n_nationkey") + 2).alias("_row"),
        )
        return stamp_metadata(rows, SOURCES["regions"], "1995-01-01", "1995-01-01 02:00:00", "_row")

    def _orders(self) -> DataFrame:
        """Urgent pending orders arrive twice: 90 minutes later with a corrected total."""
        key = F.col("o_orderkey")
        replayed = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
        status = (
            F.when(F.col("o_orderstatus") == "F", " delivered").when(F.col("o_orderstatus") == "O", "shipped ")
            .when(key % 2 == 0, "placed").otherwise("cancelled")
        )
        cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
        updated = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("_copy") * 90)
        rows = (
            self._spread("orders")
            .withColumn("_copy", F.explode(F.when(replayed, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select(
                key.cast("string").alias("order_id"),
                F.when(key % 200 == 0, F.col("o_custkey") + 10_000_000).otherwise(F.col("o_custkey")).cast("string").alias("customer_id"),
                F.col("o_orderdate").cast("string").alias("order_ts"),
                status.alias("status"),
                (cents + F.col("_copy") * 137).cast("string").alias("total_amount_cents"),
                F.lit("USD").alias("currency"),
                updated.cast("string").alias("updated_at"),
                (key * 2 + F.col("_copy")).alias("_row"),
                F.year("o_orderdate").cast("string").alias("_batch"),
                (updated + F.make_dt_interval(F.lit(1))).alias("_at"),
            )
        )
        return stamp_metadata(rows, SOURCES["orders"], F.col("_batch"), F.col("_at"), "_row")

    def _item_id(self) -> Column:
        return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))

    def _line_row(self) -> Column:
        return F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")

    def _order_items(self) -> DataFrame:
        """(order, line number) repeats in the given table, which is the replay to remove here."""
        price = F.round(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("bigint")
        kind = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 1000
        rows = self._spread("lineitem").select(
            self._item_id().alias("item_id"),
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_quantity").cast("bigint").cast("string").alias("quantity"),
            F.when(kind == 0, F.lit(0)).when(kind == 1, price * 25).otherwise(price).cast("string").alias("unit_price_cents"),
            F.col("l_shipdate").cast("string").alias("updated_at"),
            self._line_row().alias("_row"),
            F.year("l_shipdate").cast("string").alias("_batch"),
            (F.col("l_shipdate") + F.make_dt_interval(F.lit(1))).alias("_at"),
        )
        return stamp_metadata(rows, SOURCES["order_items"], F.col("_batch"), F.col("_at"), "_row")

    def _payments(self) -> DataFrame:
        """Low-priority orders are not paid before they are final. Urgent final orders first report a
        pending payment; high-priority final ones have a small second, refunded payment."""
        key, priority, final = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus") == "F"
        kinds = (
            F.when(final & (priority == "1-URGENT"), F.array(F.lit(0), F.lit(1)))
            .when(final & (priority == "2-HIGH"), F.array(F.lit(0), F.lit(2)))
            .when(~final & (priority == "5-LOW"), F.array().cast("array<int>"))
            .otherwise(F.array(F.lit(0)))
        )
        kind = F.col("_kind")
        cancelled = (F.col("o_orderstatus") == "P") & (key % 2 == 1)
        status = (
            F.when(kind == 1, "pending").when(kind == 2, "refunded").when(cancelled, "failed")
            .when(key % 60 == 0, "pending").when(key % 50 == 0, "refunded").otherwise("settled")
        )
        hours = F.when(kind == 1, 1).when(key % 50 == 1, 5 * 24).otherwise(3)
        updated = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), hours)
        cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
        method = F.when(key % 3 == 0, "card").when(key % 3 == 1, "paypal").otherwise("bank_transfer")
        rows = self._spread("orders").withColumn("_kind", F.explode(kinds)).select(
            F.concat(F.when(kind == 2, "PMR").otherwise("PM"), key.cast("string")).alias("payment_id"),
            key.cast("string").alias("order_id"),
            F.when(kind == 2, F.lit(500)).otherwise(cents).cast("string").alias("amount_cents"),
            status.alias("status"),
            F.concat(F.lit(" "), method).alias("method"),
            F.col("o_orderdate").cast("string").alias("event_ts"),
            updated.cast("string").alias("updated_at"),
            (key * 4 + kind).alias("_row"),
            F.year("o_orderdate").cast("string").alias("_batch"),
            (updated + F.make_dt_interval(F.lit(1))).alias("_at"),
        )
        return stamp_metadata(rows, SOURCES["payments"], F.col("_batch"), F.col("_at"), "_row")

    def _returns(self) -> DataFrame:
        """Lines flagged as returned."""
        part = F.col("l_partkey") % 5
        reason = (
            F.when(part == 0, "wrong_item").when(part == 1, "damaged ").when(part == 2, "not_as_described")
            .when(part == 3, "better_price").otherwise("changed_mind")
        )
        at = F.col("l_shipdate") + F.make_dt_interval(F.lit(7))
        rows = self._spread("lineitem").where("l_returnflag = 'R'").select(
            F.concat(F.lit("R"), self._item_id()).alias("return_id"),
            self._item_id().alias("order_item_id"),
            at.cast("string").alias("returned_at"),
            reason.alias("reason"),
            F.lit("1").alias("quantity"),
            (at + F.make_dt_interval(F.lit(1))).cast("string").alias("updated_at"),
            self._line_row().alias("_row"),
            F.year(at).cast("string").alias("_batch"),
            (at + F.make_dt_interval(F.lit(1))).alias("_at"),
        )
        return stamp_metadata(rows, SOURCES["returns"], F.col("_batch"), F.col("_at"), "_row")

    def _products(self) -> DataFrame:
        key = F.col("p_partkey")
        kind = F.col("p_type")
        category = F.when(key % 3 == 0, F.lower(kind)).when(key % 3 == 1, F.upper(kind)).otherwise(F.initcap(kind))
        rows = self.table("part").select(
            key.cast("string").alias("product_id"),
            F.concat(F.lit(" "), F.col("p_name")).alias("name"),
            F.concat(F.lit(" "), category).alias("category"),
            F.round(F.col("p_retailprice") * 100).cast("bigint").cast("string").alias("price_cents"),
            F.when(key % 20 == 0, "false").when(key % 20 == 1, "YES").when(key % 20 == 2, "1").otherwise("true").alias("active"),
            F.when(key % 10 == 0, "").otherwise(F.col("p_brand")).alias("brand"),
            (key + 1).alias("_row"),
        )
        return stamp_metadata(rows, SOURCES["products"], "2001-08-02", "2001-11-30 01:00:00", "_row")

    def _inventory_levels(self) -> DataFrame:
        """Small parts are counted again a day later."""
        key, again = F.col("p_partkey"), F.col("_reading")
        small = F.col("p_size") <= 12
        stock = F.when(again == 0, key * 7919 % 901).otherwise(key * 104729 % 901)
        at = F.lit("2001-08-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(again)
        warehouse = F.when(key % 3 == 0, "WH-EAST").when(key % 3 == 1, "WH-WEST").otherwise("WH-CENTRAL")
        rows = (
            self.table("part")
            .withColumn("_reading", F.explode(F.when(small, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select(
                key.cast("string").alias("product_id"), warehouse.alias("warehouse_id"),
                stock.cast("string").alias("stock_on_hand"), F.lit("60").alias("reorder_point"),
                at.cast("string").alias("updated_at"), (key * 2 + again).alias("_row"),
                at.cast("date").cast("string").alias("_batch"), (at + F.make_dt_interval(F.lit(1))).alias("_at"),
            )
        )
        return stamp_metadata(rows, SOURCES["inventory_levels"], F.col("_batch"), F.col("_at"), "_row")

    # Order and event lines as NDJSON text

    EVENT_PAYLOAD = ("event_id", "user_id", "event_type", "ts", "props")

    def event_lines(self) -> DataFrame:
        """One JSON line per event. Some lines are cut, not JSON, a JSON array, blank, or an object with text
        behind it, followed by itself, or in single quotes."""
        key = F.col("event_id")
        at = F.concat(F.translate(F.substring(F.col("ts").cast("string"), 1, 19), " ", "T"), F.lit("Z"))
        line = F.concat(
            F.lit('{"event_id":'), key.cast("string"), F.lit(',"user_id":'), F.col("user_id").cast("string"),
            F.lit(',"event_type":"'), F.col("event_type"), F.lit('","ts":"'), at,
            F.lit('","extra":true,"props":'), F.col("props"), F.lit("}"),
        )
        broken = (
            F.when(key % 500 == 3, F.substring(line, 1, 20)).when(key % 500 == 4, "not-json")
            .when(key % 500 == 5, "[1]").when(key % 500 == 6, "  ")
            .when(key % 500 == 7, F.concat(line, F.lit(" xyz"))).when(key % 500 == 8, F.concat(line, line))
            .when(key % 500 == 9, F.translate(line, '"', "'"))
        )
        return self._spread("events").select(
            F.coalesce(broken, line).alias("value"),
            F.concat(F.lit("dt="), F.col("ts").cast("date").cast("string"), F.lit(".ndjson")).alias("source_file"),
            key.alias("source_row_number"),
        )

    def order_lines(self) -> DataFrame:
        """The raw orders as NDJSON lines."""
        spec = SOURCES["orders"]
        return self.raw("orders").select(
            F.to_json(F.struct(*spec.payload)).alias("value"),
            F.lit("orders.ndjson").alias("source_file"),
            F.col("_source_row_number").alias("source_row_number"),
        )
