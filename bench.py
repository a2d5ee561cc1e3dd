"""Headline timings as one JSON line.

Builds and writes the whole warehouse from the given tables, loads order lines through the ingestion run,
and runs single tables, marts and reports, at $BENCH_SF_DIR on local[$BENCH_CPUS]. Each value is one wall-clock
run; the only warm-up is one small count.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))

QUERIES = (
    "scd2_snapshot dim_customer fct_orders fct_order_items fct_payments fct_returns mart_sales "
    "mart_customer_retention mart_product_performance mart_returns mart_inventory stg_orders stg_order_items scd2_asof_join star_join merge_upsert incremental_lookback "
    "int_payment_status int_return_metrics daily_net_revenue top_products bq01_monthly_revenue_by_region "
    "bq05_cohorts bq06_rank_movement revenue_rank dq_price_outlier_median dup_vs_existing ndjson_parse_valid "
    "events_daily_window obs_quality_checks"
).split()


def main() -> None:
    from tidemark.catalog.queries import registered
    from tidemark.catalog.warehouse import Warehouse
    from tidemark.plans import ingest
    from tidemark.schemas import SOURCES
    from tidemark.session import INPUT_PARTITIONS, build_session, shared_dir
    from tidemark.sources.files import scan_ndjson_lines
    from tidemark.sources.store import RawStore

    spark = build_session("tidemark-bench", f"local[{CPUS}]", shuffle_partitions=int(CPUS))
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set(INPUT_PARTITIONS, CPUS)  # one row group a table at this size
    warehouse, timings = Warehouse(spark, SF_DIR), {}
    warehouse.inputs.table("region").count()

    def timed(name, action):
        started = time.perf_counter()
        action()
        timings[name] = round(time.perf_counter() - started, 3)

    timed("build_all", warehouse.build)
    landing = f"{shared_dir(spark)}/bench-landing-{time.time_ns()}"
    lines = warehouse.inputs.order_lines().select("value")
    lines.write.text(landing)
    store = RawStore(spark, f"{landing}-store")
    timed("load_orders_ndjson", lambda: ingest.run_ndjson(
        store, SOURCES["orders"], scan_ndjson_lines(spark, landing), "bench", "2001-12-01 00:00:00",
        known_customers=warehouse.inputs.raw("customers"),
    ))
    for name in QUERIES:
        timed(name, lambda: registered()[name](spark, SF_DIR).write.format("noop").mode("overwrite").save())

    total = sum(timings.values())
    print(json.dumps({
        "metric": "warehouse_build_and_queries", "value": round(total, 3), "unit": "sec", "queries": timings,
        "sf": os.path.basename(SF_DIR.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
