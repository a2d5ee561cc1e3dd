"""One entry per operator and query. Each gets a ``Warehouse`` and returns a DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import functions as fn
from tidemark.catalog.inputs import FIRST_SNAPSHOT, NOW, SECOND_SNAPSHOT, Inputs
from tidemark.catalog.warehouse import Warehouse
from tidemark.operators import dedup, intake, joins, merge, quality, ranking, scd2
from tidemark.plans import (
    checks, core, drift, history, increments, ingest, marts, observability, refresh, reports, staging, summaries,
)
from tidemark.schemas import CONTRACTED_TABLES, ORDER_STATUSES, SOURCES, SourceSpec, contract
from tidemark.session import light_driver, partitions_for, shared_dir, stored_bytes
from tidemark.sources import files, relational
from tidemark.sources.known_keys import KnownKeys
from tidemark.sources.store import RawStore, current_marks
from tidemark.sources.tables import ManifestTable
from tidemark.streaming import jobs

MARK = "1999-06-01 00:00:00"
CUT = "1998-07-01 00:00:00"
LATE_CUT = "2000-04-01 00:00:00"
EVENTS = SourceSpec("events", "ndjson", ("event_id",), Inputs.EVENT_PAYLOAD, "ts", True)

_queries: dict[str, Callable[[Warehouse], DataFrame]] = {}
_runs = iter(range(10**9))


_built: set[str] = set()


def query(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    _queries[build.__name__] = build
    return build


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, sf_dir: widen(build(Warehouse(spark, sf_dir)))

    return {name: bind(build) for name, build in _queries.items()}


def widen(df: DataFrame) -> DataFrame:
    """Small integers as BIGINT."""
    small = (T.ShortType, T.IntegerType, T.ByteType)
    return df.withColumns({
        f.name: F.col(f.name).cast("bigint") for f in df.schema.fields if isinstance(f.dataType, small)
    })


def _fresh(w: Warehouse, name: str) -> str:
    """A folder no earlier run has used."""
    return f"{shared_dir(w.spark)}/runs/{name}-{next(_runs)}"


def _count(df: DataFrame, **labels: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).select(*[F.lit(v).alias(k) for k, v in labels.items()], "rows")


def _union(frames: list[DataFrame]) -> DataFrame:
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame)
    return combined


# Scans


@query
def scan_csv_customers(w):
    """Files of two column orders; some cells have line breaks."""
    folder, spec = _fresh(w, "csv"), SOURCES["customers"]
    second_name = F.when(F.col("customer_id").cast("bigint") % 50 == 0, F.concat("last_name", F.lit("\nII"))).otherwise(F.col("last_name"))
    customers = w.inputs.raw("customers").select(*spec.payload).withColumn("last_name", second_name)
    odd = F.col("customer_id").cast("bigint") % 2 == 1
    for name, rows, columns in (("odd", odd, spec.payload), ("even", ~odd, reversed(spec.payload))):
        customers.where(rows).select(*columns).write.csv(
            f"{folder}/{name}", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    return files.scan_csv(w.spark, f"{folder}/*", spec).select(*spec.payload)


@query
def ndjson_parse_valid(w):
    parsed = intake.parse_json_lines(w.inputs.event_lines(), EVENTS.payload_schema)
    return parsed.where("not _malformed").drop("_malformed", "_line")


@query
def ndjson_quarantine(w):
    parsed = intake.parse_json_lines(w.inputs.event_lines(), EVENTS.payload_schema)
    return intake.malformed_entries(parsed, "source_file", "source_row_number")


@query
def scan_ndjson_files(w):
    """Every line of the daily files with its file and number, blank and broken ones included."""
    folder = _fresh(w, "ndjson")
    lines = w.inputs.event_lines().withColumn("dt", F.substring("source_file", 4, 10))
    lines.repartition("dt").sortWithinPartitions("dt", "source_row_number").select("dt", "value").write.partitionBy("dt").text(folder)
    day = F.concat(F.lit("dt="), F.col("dt").cast("string"), F.lit(".ndjson"))
    return files.scan_ndjson_lines(w.spark, folder).select("value", day.alias("day_file"), F.col("source_row_number").alias("line_number"))


@query
def scan_json_array_products(w):
    """Landed product documents of 1,000 products; every other one is of the version without brand."""
    folder, spec = _fresh(w, "json"), SOURCES["products"]
    document = F.floor(F.col("product_id").cast("bigint") / 1000)
    products = w.inputs.raw("products").withColumn("document", document).withColumn(
        "brand", F.when(document % 2 == 1, F.col("brand"))
    )
    (
        products.groupBy("document")
        .agg(F.to_json(F.collect_list(F.struct(*spec.payload))).alias("value"))
        .write.partitionBy("document").text(folder)
    )
    return files.scan_json_array(w.spark, folder, spec).select(*spec.payload)


@query
def incremental_scan(w):
    """Columns and mark filter pushed to the source, values in raw text form."""
    columns = ["o_orderkey", "o_custkey", "o_orderdate"]
    since = F.lit(MARK).cast("timestamp_ntz")
    return relational.as_text(relational.increment(w.inputs.table("orders"), columns, "o_orderdate", since))


@query
def equal_depth_ranges(w):
    """A key whose values lie ever further apart, read in ranges cut by a sketch of it: all rows, in ranges of like size.
    The cube of a key outgrows BIGINT from 2,097,152 on."""
    key = F.col("o_orderkey").cast("decimal(19,0)")
    orders = w.inputs.table("orders").select((key * F.col("o_orderkey") * F.col("o_orderkey")).cast("decimal(38,0)").alias("k"))
    predicates = relational.range_predicates("k", relational.equal_depth_bounds(orders, "k", 16))
    sizes = orders.agg(F.array(*(F.count_if(F.expr(p)) for p in predicates)).alias("rows"))
    total = F.aggregate("rows", F.lit(0).cast("bigint"), lambda a, b: a + b)
    return sizes.select(
        F.size("rows").alias("ranges"), total.alias("rows_read"), (F.array_max("rows") < 2 * F.array_min("rows")).alias("alike")
    )


@query
def raw_stringify(w):
    return relational.as_text(w.inputs.table("orders"))


# Sinks


def _per_batch(store: RawStore, source: str) -> DataFrame:
    return store.raw(SOURCES[source]).groupBy("_batch_id").agg(F.count(F.lit(1)).alias("rows"))


@query
def raw_load_batch(w):
    store = RawStore(w.spark, _fresh(w, "raw"))
    store.write_batch(w.inputs.raw("orders"), SOURCES["orders"])
    return _per_batch(store, "orders")


@query
def raw_replace_batch(w):
    """All yearly batches, then 1998 again with each total one cent higher."""
    store, spec = RawStore(w.spark, _fresh(w, "raw")), SOURCES["orders"]
    orders = w.inputs.raw("orders")
    store.write_batch(orders, spec)
    again = orders.where("_batch_id = '1998'").withColumn(
        "total_amount_cents", (F.col("total_amount_cents").cast("bigint") + 1).cast("string")
    )
    store.write_batch(again, spec)
    return store.raw(spec).groupBy("_batch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("total_amount_cents").cast("bigint")).alias("cents")
    )


@query
def raw_replace_snapshot(w):
    store, spec = RawStore(w.spark, _fresh(w, "raw")), SOURCES["customers"]
    for rows, batch in ((w.inputs.raw("customers"), "1995-01-01"), (w.inputs.customers_second(), "2000-01-01")):
        store.write_batch(rows, spec)
        store.commit_snapshot(spec, batch, f"{batch} 02:00:00")
    store.drop_superseded(spec)
    return _per_batch(store, "customers")


@query
def raw_empty_noop(w):
    store, spec = RawStore(w.spark, _fresh(w, "raw")), SOURCES["orders"]
    store.write_batch(w.inputs.raw("orders"), spec)
    store.write_batch(w.inputs.raw("orders").where(F.col("updated_at") > "2100"), spec)
    return _count(store.raw(spec), source_name="orders")


@query
def quarantine_write(w):
    """The same batch of rejects written twice is there once."""
    store = RawStore(w.spark, _fresh(w, "quarantine"))
    for _ in range(2):
        store.write_quarantine(_gated(w), SOURCES["orders"], "batch-1", NOW)
    return intake.count_by_reason(store.quarantine(SOURCES["orders"]))


@query
def lineage_upsert(w):
    store = RawStore(w.spark, _fresh(w, "lineage"))
    for source in ("orders", "returns", "orders"):
        n = w.inputs.raw(source).count()
        counts = {"rows_extracted": n, "rows_loaded": n, "rows_quarantined": 0}
        store.record_lineage(SOURCES[source], "batch-1", NOW, counts, "full")
    return store.lineage().select("batch_id", "source_name", "source_ref", "target_raw_table", "rows_loaded", "run_mode")


@query
def watermark_upsert(w):
    """A mark, a lower one and the same again: only the first moves it."""
    store, spec = RawStore(w.spark, _fresh(w, "marks")), SOURCES["orders"]
    high, low = w.inputs.raw("orders").agg(F.max("updated_at"), F.min("updated_at")).first()
    moved = [store.record_mark(spec, value, f"b{n}", NOW) for n, value in enumerate((high, low, high))]
    return store.marks().select(
        "source_name", "watermark_field", "watermark_value", "last_batch_id",
        F.lit(",".join(str(m).lower() for m in moved)).alias("moved"),
    )


@query
def materialize_layers(w):
    """A view, a snapshot, a table merged from two increments and a rebuilt table."""
    w.staged("orders").createOrReplaceTempView("stg_orders")
    path, raw = f"{_fresh(w, 'layers')}/fct_orders", w.inputs.raw("orders")
    for until in (LATE_CUT, None):
        _add_increment(w, path, "fct_orders", raw, until)
    return _union([
        _count(w.spark.table("stg_orders"), layer="staging", kind="view", table_name="stg_orders"),
        _count(w.table("snap_customer"), layer="core", kind="snapshot", table_name="snap_customer"),
        _count(increments.stored_fact(w.spark, path, "fct_orders"), layer="core", kind="incremental", table_name="fct_orders"),
        _count(w.table("mart_sales"), layer="marts", kind="table", table_name="mart_sales"),
    ])


# Intake


@query
def raw_project(w):
    """Products that lack the brand and carry a surplus column."""
    drifted = w.inputs.raw("products").drop("brand").withColumn("surplus", F.lit("x"))
    return intake.project_payload(drifted, SOURCES["products"])


@query
def raw_metadata(w):
    return w.inputs.raw("orders")


@query
def hwm_filter(w):
    return intake.above_mark(w.inputs.raw("orders"), "updated_at", MARK).select("order_id", "updated_at")


@query
def hwm_skipped_count(w):
    fresh = intake.is_above_mark("updated_at", MARK)
    return w.inputs.raw("orders").agg(
        F.count_if(fresh).alias("extracted"), F.count_if(~fresh).alias("skipped_replayed")
    )


@query
def hwm_max(w):
    return relational.high_mark(w.inputs.raw("orders"), "updated_at")


def _batch_marks(w):
    """One mark per source and batch, in the layout of the stored history."""
    marked = [s for s in SOURCES.values() if s.watermark]
    return _union([
        w.inputs.raw(s.name).groupBy(F.col("_batch_id").alias("last_batch_id")).agg(
            F.max(s.watermark).alias("watermark_value"), F.max("_ingested_at").alias("advanced_at")
        ).withColumns({"source_name": F.lit(s.name), "watermark_field": F.lit(s.watermark)})
        for s in marked
    ])


@query
def watermark_monotonic(w):
    return current_marks(_batch_marks(w)).select("source_name", "watermark_field", "watermark_value")


@query
def fk_gate_kept(w):
    kept = intake.fk_kept(w.inputs.raw("orders"), "customer_id", w.inputs.raw("customers"), "customer_id")
    return kept.select("order_id", "customer_id", "_source_row_number")


def _gated(w):
    rejected = intake.fk_rejected(w.inputs.raw("orders"), "customer_id", w.inputs.raw("customers"), "customer_id")
    return intake.rejected_entries(rejected, SOURCES["orders"], "_source_row_number")


@query
def fk_gate_quarantined(w):
    return _gated(w)


@query
def dup_in_batch(w):
    return dedup.duplicates_in_batch(w.inputs.raw("order_items"), ["item_id"])


@query
def dup_vs_existing(w):
    items = w.inputs.raw("order_items")
    newest = F.col("_batch_id") == "2001"
    return dedup.duplicates_vs_existing(items.where(newest), items.where(~newest), ["item_id"], lambda keys: w.stage(keys, "new-keys"))


def _quarantine(w):
    return ndjson_quarantine(w).unionByName(_gated(w))


@query
def dup_vs_known_keys(w):
    """The same as dup_vs_existing from an index of the other batches' keys: their rows are not read for it."""
    items = w.inputs.raw("order_items").select("_batch_id", "item_id")
    known = KnownKeys(w.spark, _fresh(w, "known"), ("item_id",))
    known.add(items)
    newest = w.stage(items.where("_batch_id = '2001'"), "new-keys")
    return known.duplicates(newest, "2001")


@query
def quarantine_union(w):
    return _quarantine(w)


@query
def quarantine_by_reason(w):
    return intake.count_by_reason(_quarantine(w))


@query
def ingest_run_stats(w):
    """Orders up to a date, all orders, all orders again in full."""
    store, spec = RawStore(w.spark, _fresh(w, "ingest")), SOURCES["orders"]
    known = w.inputs.raw("customers")
    lines = w.inputs.order_lines()
    early = lines.where(F.get_json_object("value", "$.updated_at") <= MARK)
    runs = [
        ingest.run_ndjson(store, spec, early, "run-1", "2001-08-02 01:00:00", known_customers=known),
        ingest.run_ndjson(store, spec, lines, "run-2", "2001-08-03 01:00:00", known_customers=known),
        ingest.run_ndjson(store, spec, lines, "run-2", "2001-08-04 01:00:00", known_customers=known, full=True),
    ]
    columns = """batch_id string, source string, extracted bigint, loaded bigint, replaced_prior_rows bigint,
        quarantined bigint, duplicates_in_batch bigint, duplicates_vs_existing_batches bigint,
        skipped_replayed bigint, watermark_advanced boolean, max_observed_watermark string"""
    names = T.StructType.fromDDL(columns).fieldNames()
    return w.spark.createDataFrame([tuple(run[c] for c in names) for run in runs], columns)


@query
def ingest_stats(w):
    """The counts of one run over all orders as one aggregate, without writing."""
    parsed = intake.parse_json_lines(w.inputs.order_lines(), SOURCES["orders"].payload_schema)
    flagged = intake.flag_known_keys(parsed, "customer_id", w.inputs.raw("customers"), "customer_id", "known")
    bad, known = F.col("_malformed"), F.col("known")
    return flagged.agg(
        F.count_if(~bad).alias("extracted"), F.count_if(~bad & known).alias("loaded"),
        F.count_if(bad | ~known).alias("quarantined"), F.max("updated_at").alias("max_observed_watermark"),
    )


@query
def quarantine_threshold(w):
    return checks.quarantine_threshold(_quarantine(w))


def _drifted_products(w):
    """The small parts come from the older source version, which has no brand."""
    products = w.inputs.raw("products")
    small = w.inputs.table("part").where("p_size <= 25").select(F.col("p_partkey").cast("string").alias("product_id"))
    older = products.join(small, "product_id", "left_semi").drop("brand")
    newer = products.join(small, "product_id", "left_anti")
    return newer.unionByName(older, allowMissingColumns=True)


@query
def schema_drift_union(w):
    return _drifted_products(w).select(*SOURCES["products"].payload)


# Staging


def _staged(source):
    def build(w):
        return w.staged(source)

    build.__name__ = f"stg_{source}"
    return query(build)


for _source in SOURCES:
    _staged(_source)


@query
def dedup_latest(w):
    return dedup.latest_by_key(w.inputs.raw("order_items"), ["item_id"], "updated_at").select(
        "item_id", "product_id", "updated_at", "_source_row_number"
    )


@query
def trailing_30d_filter(w):
    return marts.trailing_orders(w.table("fct_orders")).select("order_id", "order_ts", "status")


@query
def repeat_customers(w):
    return (
        marts.revenue_orders(w.table("fct_orders")).groupBy("customer_sk")
        .agg(F.count(F.lit(1)).alias("order_count"), F.min("order_ts").alias("first_order"), F.max("order_ts").alias("last_order"))
        .where("order_count > 1")
    )


@query
def late_payments(w):
    return checks.late_payments(w.staged("payments")).select("payment_id", "event_ts", "updated_at")


# Scalar functions over whole tables


@query
def fn_text(w):
    return w.inputs.raw("customers").select(
        "customer_id", fn.tidy("first_name").alias("first_name"), fn.folded("city").alias("city"),
        fn.blank_to_null(fn.folded("email")).alias("email"), fn.raw_excerpt("last_name").alias("excerpt"),
        fn.is_truthy("segment").alias("truthy_segment"),
    )


@query
def fn_cast(w):
    return w.inputs.raw("orders").select(
        "order_id", F.col("order_ts").cast("date").alias("order_date"), staging.instant("updated_at").alias("updated_at"),
        staging.whole("total_amount_cents").alias("cents"), F.col("order_id").cast("int").cast("float").alias("order_no"),
        "_source_row_number",
    )


@query
def surrogate_key(w):
    return w.staged("orders").select(
        "order_id", fn.surrogate_key("order_id").alias("single_key"),
        fn.surrogate_key("order_id", "updated_at").alias("composite_key"),
        fn.surrogate_key("order_id", F.nullif(F.col("status"), F.lit("placed"))).alias("nullable_key"),
    )


@query
def cents_to_dollars(w):
    return w.staged("orders").select("order_id", fn.cents_to_dollars("total_amount_cents").alias("dollars"))


@query
def fn_null_safe_math(w):
    stock, price = F.col("stock_on_hand"), F.col("reorder_point")
    spread = stock - price
    return w.staged("inventory_levels").select(
        "product_id", "warehouse_id",
        fn.guarded_ratio(stock, F.nullif(stock, F.lit(0))).alias("self_ratio"),
        fn.guarded_ratio(price, stock).alias("reorder_ratio"),
        fn.whole_ratio(stock, spread / F.lit(7.0)).alias("whole_weeks"),
        F.coalesce(F.nullif(stock, F.lit(0)), F.lit(-1)).alias("stock_or_default"),
        F.coalesce(F.nullif(stock, F.lit(0)) <= price, F.lit(False)).alias("low"),
    )


@query
def fn_date_parts(w):
    days = w.inputs.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("_day"))
    parts = fn.calendar_columns("_day")
    return days.select(
        "o_orderkey", *[e.alias(n) for n, e in parts.items()], fn.month_start("_day").alias("month_start"),
        fn.days_between("_day", F.lit("2001-12-31").cast("date")).alias("days_left"),
        F.date_add("_day", 30).alias("due"),
    )


@query
def email_hash(w):
    return w.inputs.raw("customers").select("customer_id", fn.email_hash("email").alias("email_hash"))


# Dimensions, history, facts


def _planned(table):
    def build(w):
        return w.plan(table)

    build.__name__ = table
    return query(build)


for _table in CONTRACTED_TABLES:
    _planned(_table)


@query
def scd2_asof_join(w):
    matched = joins.as_of(
        w.staged("orders").select("order_id", "customer_id", "order_ts"),
        w.table("dim_customer").select("customer_id", "customer_sk", "city", scd2.VALID_FROM, scd2.VALID_TO),
        "customer_id", "order_ts",
    )
    return matched


@query
def unmatched_orders(w):
    return checks.unmatched_orders(w.staged("orders"), w.table("fct_orders"))


@query
def scd2_snapshot(w):
    return w.plan("snap_customer")


@query
def scd2_idempotent(w):
    """The second snapshot applied once more: versions before, after, and in both."""
    history = w.table("snap_customer")
    second = core.customer_source(staging.stg_customers(w.inputs.customers_second()))
    again = scd2.snapshot(history, second, "customer_id", SECOND_SNAPSHOT)
    key = [scd2.VERSION_ID, scd2.VALID_TO]
    same = history.select(*key).join(
        again.select(*[F.col(c).alias(f"_{c}") for c in key]),
        (F.col(key[0]) == F.col(f"_{key[0]}")) & F.col(key[1]).eqNullSafe(F.col(f"_{key[1]}")), "left_semi",
    )
    counts = [_count(history, state="before"), _count(again, state="after"), _count(same, state="unchanged")]
    return _union(counts)


@query
def scd2_partitioned(w):
    """Both snapshots, and the second one once more, applied to a history whose closed versions are never opened again."""
    kept = history.VersionHistory(w.spark, _fresh(w, "history"), "customer_id")
    first, second = w.staged("customers"), staging.stg_customers(w.inputs.customers_second())
    for rows, at in ((first, FIRST_SNAPSHOT), (second, SECOND_SNAPSHOT), (second, SECOND_SNAPSHOT)):
        kept.snapshot(core.customer_source(rows), at)
    return kept.read()


def _both_snapshots(w):
    """Both snapshot files stacked as open versions, which breaks every rule of a history."""
    stacked = w.staged("customers").unionByName(staging.stg_customers(w.inputs.customers_second()))
    return scd2.open_versions(stacked.select(*core.CUSTOMER_ATTRIBUTES), "customer_id")


@query
def scd2_dup_versions(w):
    return scd2.duplicate_versions(_both_snapshots(w), "customer_id")


@query
def scd2_gap_check(w):
    return scd2.with_next_start(w.table("snap_customer"), "customer_id").where(F.col("next_valid_from").isNotNull()).select(
        "customer_id", scd2.VALID_FROM, scd2.VALID_TO, "next_valid_from"
    )


@query
def scd2_violations(w):
    """On the history without the versions the second snapshot opened late in the year, and on both
    files stacked."""
    history = w.table("snap_customer")
    shifted = history.withColumn(
        scd2.VALID_TO, F.col(scd2.VALID_TO) - F.make_dt_interval(F.lit(1))
    )
    return _union([scd2.violations(h, "customer_id") for h in (_both_snapshots(w), shifted)])


@query
def star_join(w):
    t = w.keyed
    return (
        t("fct_order_items").select("item_id", "order_sk", "product_sk", "line_amount_cents")
        .join(t("fct_orders").select("order_sk", "order_id", "customer_sk", "order_date_sk"), "order_sk")
        .join(t("dim_product").select("product_sk", "category"), "product_sk")
        .join(t("dim_customer").select("customer_sk", "segment", "region_sk"), "customer_sk")
        .join(t("dim_region").select("region_sk", "region_name", "country"), "region_sk")
        .join(t("dim_date").select(F.col("date_sk").alias("order_date_sk"), "date"), "order_date_sk")
        .select("item_id", "order_id", "date", "category", "segment", "region_name", "country", "line_amount_cents")
    )


@query
def orphan_items(w):
    """Staged lines without an order in the fact."""
    return joins.without_match(w.staged("order_items"), "order_id", w.table("fct_orders"), "order_id").select("item_id", "order_id")


@query
def orphan_payments(w):
    return joins.without_match(w.staged("payments"), "order_id", w.table("fct_orders"), "order_id").select("payment_id", "order_id")


@query
def orphan_returns(w):
    return joins.without_match(w.staged("returns"), "order_item_id", w.table("fct_order_items"), "item_id").select(
        "return_id", "order_item_id"
    )


# Merge and increment


def _latest_items(df):
    return dedup.latest_by_key(df, ["item_id"], "updated_at").select(
        "item_id", "product_id", "quantity", "updated_at", "_source_row_number"
    )


@query
def merge_upsert(w):
    items = w.inputs.raw("order_items")
    target = _latest_items(items.where(F.col("updated_at") <= CUT))
    source = _latest_items(items.where(F.col("updated_at") > CUT))
    return merge.upsert(target, source, ["item_id"])


@query
def schema_append(w):
    """The increment brings a column the target does not have."""
    items = w.inputs.raw("order_items")
    target = _latest_items(items.where(F.col("updated_at") <= CUT))
    source = _latest_items(items.where(F.col("updated_at") > CUT)).withColumn("channel", F.lit("web"))
    return merge.upsert(target, source, ["item_id"])


@query
def incremental_lookback(w):
    """What an increment over a target that ends at a cut takes in: filtered before the dedup."""
    target = w.table("fct_orders").where(F.col("updated_at") <= F.lit(LATE_CUT).cast("timestamp_ntz"))
    cut = merge.lookback_cut(target)
    increment = merge.increment_before_dedup(w.inputs.raw("orders"), "updated_at", cut, "%Y-%m-%d %H:%M:%S")
    return staging.stg_orders(increment).select("order_id", "status", "total_amount_cents", "updated_at")


def _add_increment(w, path, name, raw, until):
    """Merge what of ``raw`` has arrived by a time, or all of it, into the fact stored at ``path``."""
    arrived = raw if until is None else raw.where(F.col(increments.FACTS[name].raw_mark) <= until)
    increments.build_increment(w.spark, path, name, arrived, w.keyed, period="yyyy")


@query
def incremental_parity(w):
    """Each fact built at once, and built in three increments into a partitioned table."""
    sides, folder = [], _fresh(w, "parity")
    with light_driver(w.spark) as let_go:
        for name, fact in increments.FACTS.items():
            raw, path = w.inputs.raw(fact.source), f"{folder}/{name}"
            for until in (CUT, LATE_CUT, None):
                _add_increment(w, path, name, raw, until)
                let_go()
            merged = increments.stored_fact(w.spark, path, name)
            sides += [
                quality.table_checksum(df, contract(name).fieldNames()).withColumns({"fact": F.lit(name), "path": F.lit(label)})
                for label, df in (("full", fn.unpacked(increments.full(name, raw, w.keyed, w.stage))), ("incremental", merged))
            ]
    return _union(sides)


def _refreshed(w) -> refresh.Marts:
    """Facts built in two increments, and the marts brought up to date after each; once per application and inputs."""
    folder = f"{w.root}/refreshed"
    kept = refresh.Marts(w.spark, f"{folder}/marts", f"{folder}/facts", lambda name: w.staged("inventory_levels") if name == "inventory" else w.keyed(name), period="yyyy")
    if folder not in _built:
        with light_driver(w.spark) as let_go:
            for name in ("dim_region", "dim_customer", "dim_date", "dim_product", "fct_order_items"):
                w.table(name)
            let_go()
            for until in (LATE_CUT, None):
                for name, fact in increments.FACTS.items():
                    _add_increment(w, f"{folder}/facts/{name}", name, w.inputs.raw(fact.source), until)
                    let_go()
                kept.refresh()
                sums = _kept_summaries(kept)
                for name in summaries.SUMMARIES:
                    sums.refresh(name)
                let_go()
        _built.add(folder)
    return kept


def _kept_summaries(kept: refresh.Marts) -> summaries.Summaries:
    def source(name):
        return kept.fact(name) if name in increments.FACTS else kept.table(name)

    return summaries.Summaries(kept.spark, f"{kept.root}/summaries", source)


def _by_increment(mart):
    def build(w):
        return _refreshed(w).read(mart).select(*contract(mart).fieldNames())

    build.__name__ = f"incremental_{mart}"
    build.__doc__ = f"{mart} after increments: only the groups that changed rows of the facts belong to were computed again."
    return query(build)


for _mart in checks.GRAINS:
    _by_increment(_mart)


# Intermediate views and aggregates


@query
def int_customer_orders(w):
    return marts.int_customer_orders(w.keyed("dim_customer"), w.keyed("fct_orders"))


@query
def int_payment_status(w):
    return marts.int_payment_status(w.keyed("fct_orders"), w.keyed("fct_payments"))


@query
def int_product_sales(w):
    return marts.int_product_sales(w.keyed("dim_product"), w.keyed("fct_order_items"), w.keyed("fct_orders"))


@query
def int_return_metrics(w):
    return marts.int_return_metrics(w.keyed("fct_order_items"), w.keyed("fct_returns"))


@query
def payment_status_pivot(w):
    def total(status):
        return F.sum(F.when(F.col("status") == status, F.col("amount_cents")).otherwise(0)).alias(f"{status}_cents")

    return w.table("fct_payments").groupBy("method").agg(*[total(s) for s in ("pending", "settled", "failed", "refunded")])


@query
def product_order_count(w):
    return fn.unpacked(w.keyed("fct_order_items").groupBy("product_sk").agg(F.count_distinct("order_sk").alias("order_count")))


@query
def returned_amount_by_order(w):
    return reports.returned_amounts(w.carrying("fct_returns"), w.keyed("fct_order_items"))


@query
def customer_cohort(w):
    return marts.revenue_orders(w.table("fct_orders")).groupBy("customer_sk").agg(
        F.min("order_ts").alias("first_order_ts"), fn.month_start(F.min("order_ts")).alias("cohort_month")
    )


@query
def table_checksum(w):
    table = w.table("fct_orders")
    return quality.table_checksum(table, table.columns)


@query
def cohort_retention(w):
    return w.table("mart_customer_retention").select("cohort_month", "order_month", "customers", "retention_rate")


@query
def revenue_rank(w):
    totals = w.stage(fn.unpacked(marts.product_totals(w.keyed("fct_order_items"), w.keyed("fct_orders"))), "product_sold")
    return ranking.with_rank(totals, "revenue_cents", "revenue_rank").select("product_sk", "revenue_cents", "revenue_rank")


# Consumer reports


def _from_kept_sums(report, summary):
    def build(w):
        return report(_kept_summaries(_refreshed(w)).read(summary))

    build.__name__ = f"incremental_{report.__name__}"
    build.__doc__ = f"{report.__name__} from sums that took in only the partitions the second increment changed."
    return query(build)


for _report, _summary in (
    (reports.daily_net_revenue, "sales_by_day"), (reports.daily_aov, "sales_by_day"),
    (reports.monthly_revenue_by_region, "sales_by_month"), (reports.orders_by_status, "orders_by_status"),
):
    _from_kept_sums(_report, _summary)


@query
def incremental_top_products(w):
    """top_products from the sums per product that refreshes keep; names are looked up for the rows reported."""
    kept = _refreshed(w)
    return reports.top_products_of_sums(kept.read("product_totals"), w.keyed("dim_product"))


@query
def daily_net_revenue(w):
    return reports.daily_net_revenue(w.summary("sales_by_day"))


@query
def daily_aov(w):
    return reports.daily_aov(w.summary("sales_by_day"))


@query
def cohort_grid(w):
    return reports.cohort_grid(w.table("mart_customer_retention"))


@query
def top_products(w):
    return reports.top_products(w.table("mart_product_performance"))


@query
def returns_by_reason(w):
    return reports.returns_by_reason(w.table("mart_returns"))


@query
def inventory_by_warehouse(w):
    return reports.inventory_by_warehouse(w.table("mart_inventory"))


@query
def low_stock_items(w):
    return reports.low_stock_items(w.table("mart_inventory"))


def _runs_table(w):
    raw = {s: w.inputs.raw(s) for s in observability.REPORTED_SOURCES}
    rejected = _gated(w).select(F.lit("orders").alias("_source_name"))
    return observability.pipeline_runs(raw, current_marks(_batch_marks(w)), rejected)


@query
def obs_pipeline_runs(w):
    return _runs_table(w)


@query
def freshness_status(w):
    return observability.with_staleness(_runs_table(w), NOW)


@query
def raw_counts(w):
    return observability.raw_counts({s: w.inputs.raw(s) for s in SOURCES})


@query
def lineage_listing(w):
    """One lineage row per stored order batch, as a listing."""
    store = RawStore(w.spark, _fresh(w, "listing"))
    batches = w.inputs.raw("orders").groupBy(F.col("_batch_id").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("rows_extracted")
    )
    store.record_lineage_of(SOURCES["orders"], batches.withColumns({
        "rows_loaded": F.col("rows_extracted"), "rows_quarantined": F.lit(0),
        "ingested_at": F.lit(NOW), "run_mode": F.lit("incremental"),
    }))
    return store.lineage().select("batch_id", "source_name", "rows_extracted", "rows_loaded", "run_mode").orderBy("batch_id")


@query
def raw_duplicate_ids(w):
    return observability.top_values(w.inputs.raw("orders"), "order_id", 3, "copies", at_least=2)


@query
def drift_coverage(w):
    return observability.drift_coverage(_drifted_products(w), "brand")


def _yearly_orders(w):
    """Orders with their year as the batch; amounts of 1996 tripled, and one status for most of its orders."""
    year, odd = F.year("order_ts"), F.year("order_ts") == 1996
    return w.table("fct_orders").select(
        year.alias("batch"), F.when(odd, F.col("total_amount_cents") * 3).otherwise(F.col("total_amount_cents")).alias("amount"),
        F.when(odd & (F.col("order_id").cast("bigint") % 4 > 0), "returned").otherwise(F.col("status")).alias("status"),
    )


def _sketched(w):
    sketches = drift.batch_sketches(_yearly_orders(w), "batch", ["amount"])
    return w.stage(sketches, "sketches")


@query
def drift_numeric(w):
    """Batches whose amounts are spread otherwise than those before, from stored quantile sketches."""
    return drift.numeric_drift(_sketched(w)).select("batch", "column", "n", "n_before", "drifted")


@query
def drift_category(w):
    counts = w.stage(drift.batch_counts(_yearly_orders(w), "batch", ["status"]), "counts")
    return drift.category_drift(counts).select("batch", "column", "n", "n_before", "distance", "drifted")


@query
def sketch_quantiles(w):
    """Quantiles of each batch from its sketch, and whether the exact share of rows is within the stated error."""
    found = w.stage(drift.quantiles(_sketched(w)), "quantiles")
    points = found.groupBy("batch").agg(F.collect_list(F.struct("probability", "value")).alias("points"))  # 19 each
    rows = _yearly_orders(w).where("amount is not null").join(points, "batch").select("batch", "amount", F.explode("points").alias("p"))
    exact = rows.groupBy("batch", "p.probability").agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col("amount") < F.col("p.value")).cast("int")).alias("below"),
        F.avg((F.col("amount") <= F.col("p.value")).cast("int")).alias("up_to"),
    )
    near = (F.col("below") - drift.SHARE_ERROR <= F.col("probability")) & (F.col("probability") <= F.col("up_to") + drift.SHARE_ERROR)
    return exact.select("batch", "probability", "n", near.alias("within_error"))


@query
def category_variants(w):
    return observability.top_values(w.inputs.raw("products"), "category", 6, "products")


@query
def bq01_monthly_revenue_by_region(w):
    return reports.monthly_revenue_by_region(w.summary("sales_by_month"))


@query
def bq02_aov(w):
    return reports.monthly_aov_by_region(w.summary("sales_by_month"))


@query
def bq03_orders_by_status(w):
    return reports.orders_by_status(w.summary("orders_by_status"))


@query
def bq04_repeat_rate(w):
    return reports.repeat_rate(w.table("fct_orders"))


@query
def bq05_cohorts(w):
    return reports.cohorts_by_person(w.table("fct_orders"), w.table("dim_customer"))


@query
def bq06_rank_movement(w):
    return reports.rank_movement(w.table("fct_order_items"), w.table("fct_orders"), w.table("dim_product"), w.stage)


@query
def bq07_return_rate(w):
    return reports.return_rate_by_category(w.keyed("fct_order_items"), w.keyed("fct_returns"), w.keyed("dim_product"))


@query
def bq08_return_impact(w):
    return reports.return_impact(w.summary("sales_by_month"))


# Checks


@query
def dq_not_null(w):
    return _union([
        quality.null_counts(w.staged("customers"), "stg_customers", ["customer_id", "email", "city", "segment"]),
        quality.null_counts(w.staged("products"), "stg_products", ["product_id", "category", "brand"]),
        quality.null_counts(w.table("mart_inventory"), "mart_inventory", ["product_id", "days_of_cover"]),
    ])


@query
def dq_unique(w):
    return quality.not_unique(w.inputs.raw("order_items"), ["item_id"])


@query
def dq_relationships(w):
    orders = w.inputs.raw("orders")
    return joins.without_match(orders, "customer_id", w.inputs.raw("customers"), "customer_id", null_fk=False).select(
        "order_id", "customer_id"
    )


@query
def dq_accepted_values(w):
    return quality.unaccepted_values(w.inputs.raw("orders"), "status", ORDER_STATUSES)


def _grain(mart, keys):
    def build(w):
        whole = w.table(mart)
        return quality.broken_grain(whole.unionByName(whole.where(_REPEATED[mart])), keys)

    build.__name__ = f"dq_grain_{mart}"
    return query(build)


# Checks that the built tables pass run on tables with faults put in: rows repeated, values changed, versions lost.
_REPEATED = {
    "mart_sales": "cast(order_id as bigint) % 10 = 0", "mart_customer_retention": "month(cohort_month) = 1",
    "mart_product_performance": "cast(product_id as bigint) % 10 = 0", "mart_returns": "reason = 'damaged'",
    "mart_inventory": "cast(product_id as bigint) % 10 = 0",
}


def _every_tenth(key, rest=0):
    return F.col(key).cast("bigint") % 10 == rest


for _mart, _keys in checks.GRAINS.items():
    _grain(_mart, _keys)


@query
def dq_net_le_gross(w):
    raised = F.when(_every_tenth("order_id"), F.col("gross_revenue") + 1).otherwise(F.col("net_revenue"))
    return checks.net_above_gross(w.table("mart_sales").withColumn("net_revenue", raised))


@query
def dq_status_leak(w):
    leaked = F.when(_every_tenth("order_id"), "placed").otherwise(F.col("status"))
    return checks.leaked_statuses(w.table("mart_sales").withColumn("status", leaked))


@query
def dq_no_future(w):
    return checks.future_orders(w.table("fct_orders"), "2001-01-01 00:00:00")


@query
def dq_scd2_one_version(w):
    versions = w.table("dim_customer")
    doctored = versions.where(~_every_tenth("customer_id")).unionByName(versions.where(_every_tenth("customer_id", 1)))
    return checks.not_one_version(w.table("fct_orders"), doctored)


@query
def dq_scd2_structure(w):
    history, start = w.table("snap_customer"), F.col(scd2.VALID_FROM)
    doctored = history.withColumns({
        scd2.VALID_FROM: F.when(~_every_tenth("customer_id"), start),
        scd2.VALID_TO: F.when(_every_tenth("customer_id", 1), start).otherwise(F.col(scd2.VALID_TO)),
    })
    return scd2.structure_violations(doctored, "customer_id")


@query
def dq_freshness(w):
    return observability.freshness(observability.source_counts({s: w.inputs.raw(s) for s in SOURCES}), NOW)


@query
def dq_null_rate(w):
    return quality.null_rate(w.staged("customers"), "email", 0.05)


@query
def dq_duplicate_email(w):
    return checks.shared_emails(w.staged("customers"))


@query
def dq_price_outliers(w):
    return checks.price_outliers(w.staged("order_items")).select("item_id", "unit_price_cents")


@query
def dq_price_outlier_median(w):
    return checks.price_outliers_by_median(w.staged("order_items")).select("item_id", "unit_price_cents")


@query
def dq_reconcile_sales(w):
    return checks.reconcile_sales(w.table("mart_sales"), w.table("fct_orders"))


@query
def dq_payment_reconcile(w):
    """Payment totals of the fact against those of the per-order view."""
    settled = F.col("status") == "settled"
    fact = w.table("fct_payments").agg(
        F.sum("amount_cents").alias("paid_cents"), F.sum(F.when(settled, F.col("amount_cents"))).alias("settled_cents")
    ).withColumn("side", F.lit("payments"))
    view = int_payment_status(w).agg(
        F.sum("total_paid_cents").alias("paid_cents"), F.sum("settled_cents").alias("settled_cents")
    ).withColumn("side", F.lit("orders"))
    return fact.unionByName(view)


class _CheckTables:
    """The tables that checks read. Staging and quarantine are plans; read by several checks, they are written
    first."""

    def __init__(self, w):
        self._w, self._written = w, {}

    def __call__(self, name):
        if name.startswith("raw_"):
            return self._w.inputs.raw(name.removeprefix("raw_"))
        if name != "quarantine" and not name.startswith("stg_"):
            return self._w.table(name)
        if name not in self._written:
            plan = _quarantine(self._w) if name == "quarantine" else self._w.staged(name.removeprefix("stg_"))
            self._written[name] = self.stage(plan, name)
        return self._written[name]

    def stage(self, df, name):
        return self._w.stage(df, name)


@query
def obs_quality_checks(w):
    return checks.check_results(_CheckTables(w))


@query
def dq_failures(w):
    """Violating rows stored per check and run, counted from storage."""
    folder = _fresh(w, "failures")
    failures = {
        "unique:raw_order_items.item_id": dq_unique(w), "relationships:raw_orders.customer_id": dq_relationships(w),
        "accepted_values:raw_orders.status": dq_accepted_values(w),
    }
    for _ in range(2):
        checks.store_failures(failures, folder, "run-1")
    stored = w.spark.read.parquet(folder)
    return stored.groupBy("check_name", "run_id").agg(F.count(F.lit(1)).alias("violations"))


@query
def publish_gate(w):
    """A clean version is published; one with a broken grain is written but held back."""
    table = ManifestTable(w.spark, _fresh(w, "publish"))
    sales = w.table("mart_sales")

    def audit(staged):
        found = quality.broken_grain(staged, ["order_sk"])
        return found.agg(F.count(F.lit(1)).alias("violations")).withColumn("check_name", F.lit("grain"))

    table.publish_if(sales, audit)
    table.publish_if(sales.unionByName(sales.where("status = 'shipped'")), audit)
    return table.read().agg(F.count(F.lit(1)).alias("rows"), F.sum("total_amount_cents").alias("cents")).withColumn(
        "version", F.lit(table.current_version()).cast("bigint")
    )


@query
def publish_warehouse(w):
    """All marts published after the whole check suite, then held back by one more check that fails."""
    folder = _fresh(w, "published")
    stops = [w.publish(folder, lambda: checks.check_results(_CheckTables(w)))]
    failing = _count(w.table("mart_sales"), check_name="doctored", action="fail")
    stops.append(w.publish(folder, lambda: failing))
    published = [ManifestTable(w.spark, f"{folder}/{mart}") for mart in checks.GRAINS]
    held = "; ".join(",".join(stop) for stop in stops)
    return _union([
        _count(table.read(), mart=mart).withColumns({"version": F.lit(table.current_version()).cast("bigint"), "stopped_by": F.lit(held)})
        for mart, table in zip(checks.GRAINS, published)
    ])


@query
def contract_check(w):
    """Rows of every contracted table, counted only if its schema keeps the contract."""
    return _union([
        _count(quality.enforce_contract(w.table(name), contract(name)), table_name=name) for name in CONTRACTED_TABLES
    ])


@query
def dq_volume_drift(w):
    items = w.inputs.raw("order_items").unionByName(w.inputs.raw("orders").select("_source_name", "_batch_id"), allowMissingColumns=True)
    return quality.volume_drift(items, "_source_name", "_batch_id", preceding=3, limit=2.0).select(
        "_source_name", "_batch_id", "row_count", "past_mean", "drifted"
    )


# Streams


@query
def stream_ndjson_available_now(w):
    """Event files ingested as a stream; the second run finds nothing new."""
    base = _fresh(w, "stream")
    w.inputs.event_lines().select("value").write.text(f"{base}/landing")
    store = RawStore(w.spark, f"{base}/store")
    for _ in range(2):
        jobs.ingest_ndjson(w.spark, f"{base}/landing", EVENTS, store, f"{base}/checkpoint").awaitTermination()
    return store.landed(EVENTS).groupBy(F.col("_outcome").alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))


def _event_stream(w, folder):
    """Every event twice, in files of their own."""
    events = w.inputs.table("events").withColumn("event_time", F.col("ts").cast("timestamp"))
    for copy in (1, 2):
        events.withColumn("copy", F.lit(copy)).write.mode("append").parquet(folder)
    return w.spark.readStream.schema(w.spark.read.parquet(folder).schema).parquet(folder)


@query
def stream_dedup(w):
    base = _fresh(w, "stream-dedup")
    stream = _event_stream(w, f"{base}/in")
    by_file = F.pmod(F.xxhash64("_metadata.file_path", "_metadata.file_block_start"), F.lit(64))
    unique = jobs.without_replays(stream, ["event_id"], "event_time", spread=by_file).drop("copy")
    partitions = max(partitions_for(stored_bytes(w.spark, f"{base}/in")), w.spark.sparkContext.defaultParallelism)
    jobs.append_to(unique, f"{base}/out", f"{base}/checkpoint", partitions).awaitTermination()
    return w.spark.read.parquet(f"{base}/out").select("event_id", "user_id", "event_type", "ts")


@query
def events_daily_window(w):
    return jobs.daily_counts(w.inputs.table("events"), "ts", "value", "event_type")


@query
def stream_late_rows(w):
    """Events in two batches, every third one in the second: rows and value per type, of those in time and of those that came
    behind the first batch's watermark."""
    base = _fresh(w, "stream-late")
    events = w.inputs.table("events").select("event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("event_time"))
    second = F.pmod("event_id", F.lit(3)) == 0
    for rows in (~second, second):
        events.where(rows).write.mode("append").parquet(f"{base}/in")
        stream = w.spark.readStream.schema(events.schema).parquet(f"{base}/in")
        jobs.split_late(stream, "event_time", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    sides = [
        read(w.spark, f"{base}/out", events.schema).withColumn("is_late", F.lit(is_late))
        for read, is_late in ((jobs.on_time, False), (jobs.late, True))
    ]
    return _union(sides).groupBy("event_type", "is_late").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("ids"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("value_cents")
    )


@query
def stream_upsert(w):
    """Raw order lines streamed into a table partitioned by year in several micro-batches, newest version per
    order; the corrected versions arrive before the original ones."""
    base = _fresh(w, "stream-upsert")
    spec = SOURCES["orders"]
    for corrected in (1, 0):
        rows = w.inputs.raw("orders").where(F.col("_source_row_number") % 2 == corrected)
        rows.select(*spec.payload).repartition(2).write.mode("append").parquet(f"{base}/in")
    reader = w.spark.readStream.schema(spec.payload_schema).option("maxFilesPerTrigger", 2)
    stream = reader.parquet(f"{base}/in").withColumn(
        "order_year", F.substring("order_ts", 1, 4)
    )
    jobs.upsert_stream(
        stream, f"{base}/table", ["order_id"], "updated_at", "order_year", f"{base}/checkpoint"
    ).awaitTermination()
    return ManifestTable(w.spark, f"{base}/table").read()
