"""One DuckDB statement per registered query."""

from __future__ import annotations

from verification.blocks import BLOCKS, date_parts, with_blocks

_META = "_source_name, _batch_id, _ingested_at, _source_file, _source_row_number"
_CUSTOMER_PAYLOAD = "customer_id, first_name, last_name, email, city, region_id, segment, signup_date, updated_at"
_PRODUCT_PAYLOAD = "product_id, name, category, price_cents, active, brand"
_ORDER_PAYLOAD = "order_id, customer_id, order_ts, status, total_amount_cents, currency, updated_at"
_NOW = "timestamp '2001-12-01'"


def _whole(names: str) -> dict[str, str]:
    return {name: f"select * from {name}" for name in names.split()}


def _latest_items(where: str) -> str:
    return f"""select item_id, product_id, quantity, updated_at, _source_row_number from raw_order_items {where}
        qualify row_number() over (partition by item_id
            order by updated_at desc, _batch_id desc, _source_row_number desc) = 1"""


def _digest(columns: list[str]) -> str:
    fields = " || '|' || ".join(f"coalesce('=' || cast({c} as varchar), '~')" for c in columns)
    return f"""select count(*) as row_count,
        coalesce(cast(sum(cast(cast('0x' || substr(h, 1, 8) as bigint) as hugeint)) as varchar), '0') as digest_sum,
        coalesce(bit_xor(cast('0x' || substr(h, 17, 15) as bigint)), 0) as digest_xor
        from (select md5({fields}) as h from {{table}})"""


_ORDER_COLUMNS = "order_sk order_id customer_sk order_date_sk status total_amount_cents currency order_ts updated_at".split()
_ITEM_COLUMNS = "order_item_sk item_id order_sk product_sk quantity unit_price_cents line_amount_cents updated_at".split()
_FACT_COLUMNS = {
    "fct_orders": _ORDER_COLUMNS,
    "fct_order_items": _ITEM_COLUMNS,
    "fct_payments": ["payment_sk", "payment_id", "order_sk", "payment_date_sk", "amount_cents", "status", "method", "event_ts", "updated_at"],
    "fct_returns": ["return_sk", "return_id", "order_item_sk", "return_date_sk", "reason", "quantity", "returned_at", "updated_at"],
}

_AGE = f"date_diff('second', last_ingested_at, {_NOW}) / 3600.0::double"

SQL: dict[str, str] = {
    # Scans and sinks
    "scan_csv_customers": f"""
        select {_CUSTOMER_PAYLOAD.replace("last_name", "last_name || case when customer_id::bigint % 50 = 0 then chr(10) || 'II' else '' end as last_name")}
        from raw_customers""",
    "ndjson_parse_valid": """
        select source_file, source_row_number, cast(event_id as varchar) as event_id,
            cast(user_id as varchar) as user_id, event_type, iso as ts, replace(props, ' ', '') as props
        from event_lines where event_id % 500 not between 3 and 9""",
    "ndjson_quarantine": "select * from malformed",
    "scan_ndjson_files": """
        select value, source_file as day_file, row_number() over (partition by source_file order by event_id) as line_number
        from event_lines""",
    "scan_json_array_products": f"""
        select {_PRODUCT_PAYLOAD.replace("brand", "case when (product_id::bigint // 1000) % 2 = 1 then brand end as brand")}
        from raw_products""",
    "incremental_scan": """
        select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey,
            cast(o_orderdate as varchar) as o_orderdate
        from orders where o_orderdate > timestamp '1999-06-01'""",
    "raw_stringify": """
        select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey, o_orderstatus,
            cast(o_totalprice as varchar) as o_totalprice, cast(o_orderdate as varchar) as o_orderdate, o_orderpriority
        from orders""",
    "raw_load_batch": "select _batch_id, count(*) as rows from raw_orders group by 1",
    "raw_replace_batch": """
        select _batch_id, count(*) as rows,
            cast(sum(cast(total_amount_cents as bigint) + case when _batch_id = '1998' then 1 else 0 end) as bigint) as cents
        from raw_orders group by 1""",
    "raw_replace_snapshot": "select _batch_id, count(*) as rows from raw_customers_2 group by 1",
    "raw_empty_noop": "select 'orders' as source_name, count(*) as rows from raw_orders",
    "quarantine_write": "select reason, count(*) as quarantined from gated group by 1",
    "lineage_upsert": """
        select 'batch-1' as batch_id, _source_name as source_name, _source_file as source_ref,
            'raw.' || _source_name as target_raw_table, count(*) as rows_loaded, 'full' as run_mode
        from (select _source_name, _source_file from raw_orders
              union all select _source_name, _source_file from raw_returns)
        group by all""",
    "watermark_upsert": """
        select 'orders' as source_name, 'updated_at' as watermark_field, max(updated_at) as watermark_value,
            'b0' as last_batch_id, 'true,false,false' as moved
        from raw_orders""",
    "materialize_layers": """
        select 'staging' as layer, 'view' as kind, 'stg_orders' as table_name, count(*) as rows from stg_orders
        union all select 'core', 'snapshot', 'snap_customer', count(*) from snap_customer
        union all select 'core', 'incremental', 'fct_orders', count(*) from fct_orders
        union all select 'marts', 'table', 'mart_sales', count(*) from sold""",
    # Intake
    "raw_project": f"select {_PRODUCT_PAYLOAD.replace('brand', 'cast(null as varchar) as brand')} from raw_products",
    "raw_metadata": "select * from raw_orders",
    "hwm_filter": "select order_id, updated_at from raw_orders where updated_at > '1999-06-01 00:00:00'",
    "hwm_skipped_count": """
        select count(*) filter (updated_at > '1999-06-01 00:00:00') as extracted,
            count(*) filter (updated_at <= '1999-06-01 00:00:00') as skipped_replayed from raw_orders""",
    "hwm_max": "select max(updated_at) as max_mark from raw_orders",
    "watermark_monotonic": "select * from marks",
    "fk_gate_kept": """
        select order_id, customer_id, _source_row_number from raw_orders
        where customer_id in (select customer_id from raw_customers)""",
    "fk_gate_quarantined": "select * from gated",
    "dup_in_batch": "select count(*) - count(distinct item_id) as duplicates_in_batch from raw_order_items",
    "dup_vs_existing": """
        select count(*) as duplicates_vs_existing_batches from raw_order_items
        where _batch_id = '2001' and item_id in (select item_id from raw_order_items where _batch_id <> '2001')""",
    "quarantine_union": "select * from quarantine",
    "quarantine_by_reason": "select reason, count(*) as quarantined from quarantine group by 1",
    "ingest_run_stats": """
        select batch_id, 'orders' as source, n as extracted, n - g as loaded, replaced as replaced_prior_rows,
            g as quarantined, d as duplicates_in_batch, x as duplicates_vs_existing_batches,
            skipped as skipped_replayed, advanced as watermark_advanced, mark as max_observed_watermark
        from (
            select 'run-1' as batch_id, count(*) as n, count(*) filter (bad) as g, 0 as replaced,
                count(*) filter (not bad) - count(distinct order_id) filter (not bad) as d, 0 as x, 0 as skipped,
                true as advanced, max(updated_at) as mark
            from o where early
            union all
            select 'run-2', count(*), count(*) filter (bad), 0,
                count(*) filter (not bad) - count(distinct order_id) filter (not bad),
                count(*) filter (not bad and order_id in (select order_id from o where early and not bad)),
                (select count(*) from o where early), true, max(updated_at)
            from o where not early
            union all
            select 'run-2', count(*), count(*) filter (bad),
                (select count(*) from o where not early and not bad),
                count(*) filter (not bad) - count(distinct order_id) filter (not bad),
                count(*) filter (not bad and order_id in (select order_id from o where early and not bad)),
                0, false, max(updated_at)
            from o)""",
    "ingest_stats": """
        select count(*) as extracted, count(*) - (select count(*) from gated) as loaded,
            (select count(*) from gated) as quarantined, max(updated_at) as max_observed_watermark from raw_orders""",
    "quarantine_threshold": "select count(*) as quarantined, count(*) > 10000 as exceeded from quarantine",
    "schema_drift_union": f"select {_PRODUCT_PAYLOAD} from drifted_products",
    # Staging and single-table queries
    **_whole("stg_customers stg_regions stg_products stg_orders stg_order_items stg_payments stg_returns "
             "stg_inventory_levels"),
    "dedup_latest": f"select * exclude (quantity) from ({_latest_items('')})",
    "trailing_30d_filter": "select order_id, order_ts, status from recent",
    "repeat_customers": """
        select customer_sk, n as order_count, first_ts as first_order, last_ts as last_order from first_orders where n > 1""",
    "late_payments": """
        select payment_id, event_ts, updated_at from stg_payments where date_diff('day', event_ts, updated_at) >= 3""",
    "fn_text": """
        select customer_id, trim(first_name) as first_name, lower(trim(city)) as city,
            case when trim(email) = '' then null else lower(trim(email)) end as email,
            substr(last_name, 1, 2000) as excerpt, false as truthy_segment from raw_customers""",
    "fn_cast": """
        select order_id, order_ts::date as order_date, updated_at::timestamp as updated_at,
            total_amount_cents::bigint as cents, order_id::integer::real as order_no, _source_row_number
        from raw_orders""",
    "surrogate_key": """
        select order_id, md5(order_id) as single_key, md5(order_id || '_' || updated_at) as composite_key,
            md5(order_id || '_' || case when status <> 'placed' then status end) as nullable_key from stg_orders""",
    "cents_to_dollars": "select order_id, total_amount_cents / 100.0::double as dollars from stg_orders",
    "fn_null_safe_math": """
        select product_id, warehouse_id, case when stock_on_hand <> 0 then 1.0::double end as self_ratio,
            case when stock_on_hand <> 0 then reorder_point::double / stock_on_hand end as reorder_ratio,
            case when stock_on_hand > reorder_point
                 then floor(stock_on_hand / ((stock_on_hand - reorder_point) / 7.0::double)) end as whole_weeks,
            case stock_on_hand when 0 then -1 else stock_on_hand end as stock_or_default,
            stock_on_hand <> 0 and stock_on_hand <= reorder_point as low
        from stg_inventory_levels""",
    "fn_date_parts": f"""
        select o_orderkey, {date_parts("d")}, cast(date_trunc('month', d) as date) as month_start,
            date_diff('day', d, date '2001-12-31') as days_left, d + 30 as due
        from (select o_orderkey, cast(o_orderdate as date) as d from orders)""",
    "email_hash": """
        select customer_id, case when trim(email) <> '' then sha256(lower(trim(email))) end as email_hash
        from raw_customers""",
    # Dimensions, history, facts
    **_whole("dim_region dim_product dim_customer fct_orders fct_order_items fct_payments fct_returns"),
    "dim_date": "select * from dim_date",
    "scd2_asof_join": """
        select o.order_id, o.customer_id, o.order_ts, c.customer_sk, c.city, c.dbt_valid_from, c.dbt_valid_to
        from stg_orders o join dim_customer c on c.customer_id = o.customer_id
        where o.order_ts >= c.dbt_valid_from and (c.dbt_valid_to is null or o.order_ts < c.dbt_valid_to)""",
    "unmatched_orders": """
        select order_id, customer_id, order_ts from stg_orders where order_id not in (select order_id from fct_orders)""",
    "scd2_snapshot": "select * from snap_customer",
    "scd2_idempotent": """
        select unnest(['before', 'after', 'unchanged']) as state, count(*) as rows from snap_customer group by 1""",
    "scd2_dup_versions": """
        select customer_id, dbt_valid_from, cnt from (
            select customer_id, updated_at as dbt_valid_from,
                count(*) over (partition by customer_id, updated_at) as cnt
            from (select * from stg_customers union all select * from stg_customers_2)) where cnt > 1""",
    "scd2_gap_check": """
        select customer_id, dbt_valid_from, dbt_valid_to, next_valid_from from (
            select *, lead(dbt_valid_from) over (partition by customer_id order by dbt_valid_from) as next_valid_from
            from snap_customer) where next_valid_from is not null""",
    "scd2_violations": """
        select issue, customer_id, detail from (
            select customer_id, 'validity_gap' as issue, concat_ws(' -> ', began, following) as detail
            from (
                select customer_id, dbt_valid_from as began, dbt_valid_to - interval 1 day as ended,
                    lead(dbt_valid_from) over (partition by customer_id order by dbt_valid_from) as following
                from snap_customer)
            where ended <> following
            union all by name
            select customer_id, 'multiple_current' as issue, count(*)::varchar as detail
            from (select customer_id from stg_customers union all select customer_id from stg_customers_2)
            group by customer_id having count(*) > 1)""",
    "star_join": """
        select i.item_id, o.order_id, d.date, p.category, c.segment, g.region_name, g.country, i.line_amount_cents
        from fct_order_items i join fct_orders o using (order_sk) join dim_product p using (product_sk)
        join dim_customer c using (customer_sk) join dim_region g using (region_sk)
        join dim_date d on d.date_sk = o.order_date_sk""",
    "orphan_items": """
        select i.item_id, i.order_id from stg_order_items i left join fct_orders o using (order_id)
        where o.order_sk is null""",
    "orphan_payments": """
        select p.payment_id, p.order_id from stg_payments p left join fct_orders o using (order_id)
        where o.order_sk is null""",
    "orphan_returns": """
        select r.return_id, r.order_item_id from stg_returns r left join fct_order_items i on i.item_id = r.order_item_id
        where i.item_id is null""",
    # Merge and increment
    "merge_upsert": _latest_items(""),
    "schema_append": f"""
        select *, case when updated_at > '1998-07-01 00:00:00' then 'web' end as channel from ({_latest_items("")})""",
    "incremental_lookback": """
        select order_id, status, total_amount_cents, updated_at from stg_orders
        where updated_at > (select max(updated_at) from fct_orders where updated_at <= timestamp '2000-04-01') - interval 7 day""",
    "incremental_parity": f"""
        select d.*, p.path from ({" union all ".join(f"select *, '{t}' as fact from ({_digest(c).format(table=t)})" for t, c in _FACT_COLUMNS.items())}) d,
            (values ('full'), ('incremental')) p(path)""",
    # Intermediate views and aggregates
    **_whole("int_customer_orders int_payment_status int_product_sales int_return_metrics"),
    "payment_status_pivot": "select method, " + ", ".join(
        f"cast(sum(case status when '{s}' then amount_cents else 0 end) as bigint) as {s}_cents"
        for s in ("pending", "settled", "failed", "refunded")
    ) + " from fct_payments group by method",
    "product_order_count": """
        select product_sk, count(distinct order_sk) as order_count from fct_order_items group by 1""",
    "returned_amount_by_order": """
        select order_sk, cast(sum(quantity) as bigint) as returned_units, cast(sum(cents) as bigint) as returned_amount_cents
        from returned group by 1""",
    "customer_cohort": """
        select customer_sk, first_ts as first_order_ts, cohort_month from first_orders""",
    "table_checksum": _digest(_ORDER_COLUMNS).format(table="fct_orders"),
    "cohort_retention": "select cohort_month, order_month, customers, retention_rate from mart_customer_retention",
    "revenue_rank": """
        select product_sk, cents as revenue_cents, rank() over (order by cents desc) as revenue_rank from product_sold""",
    # Marts and reports
    **_whole("mart_sales mart_customer_retention mart_product_performance mart_returns mart_inventory"),
    **{f"incremental_{mart}": f"select * from {mart}" for mart in ("mart_sales", "mart_customer_retention", "mart_product_performance", "mart_returns", "mart_inventory")},
    "daily_net_revenue": """
        select date, cents / 100.0::double as net, (sum(cents) over ())::bigint / 100.0::double as all_time_net
        from (select date, cast(sum(cast(round(net_revenue * 100) as bigint)) as bigint) as cents from mart_sales group by 1)""",
    "daily_aov": """
        select date, orders, cents / 100.0::double as rev, (cents / 100.0::double) / orders as aov
        from (select date, count(*) as orders, cast(sum(cast(round(net_revenue * 100) as bigint)) as bigint) as cents
              from mart_sales group by 1)""",
    "cohort_grid": """
        select cohort_month, order_month, retention_rate from mart_customer_retention""",
    "top_products": """
        select product_id, category, units_sold, product_revenue, return_rate from mart_product_performance
        order by product_revenue desc, product_id limit 20""",
    "returns_by_reason": """
        select reason, cast(sum(total_returned_units) as bigint) as units,
            cast(sum(cast(round(total_returned_revenue * 100) as bigint)) as bigint) / 100.0::double as rev
        from mart_returns group by 1""",
    "inventory_by_warehouse": """
        select warehouse_id, count(*) as skus, count(*) filter (low_stock_flag) as low from mart_inventory group by 1""",
    "low_stock_items": """
        select product_id, warehouse_id, stock_on_hand, reorder_point, days_of_cover from mart_inventory
        where low_stock_flag""",
    "obs_pipeline_runs": "select * from pipeline_runs",
    "freshness_status": f"select *, {_AGE} as age_hours, {_AGE} > 26 as is_stale from pipeline_runs",
    "raw_counts": "select source_name, row_count from source_counts",
    "lineage_listing": """
        select _batch_id as batch_id, 'orders' as source_name, count(*) as rows_extracted, count(*) as rows_loaded,
            'incremental' as run_mode from raw_orders group by 1""",
    "raw_duplicate_ids": """
        select order_id, count(*) as copies from raw_orders group by 1 having count(*) > 1
        order by copies desc, order_id limit 3""",
    "drift_coverage": "select brand is not null as present, count(*) as rows from drifted_products group by 1",
    "category_variants": """
        select category, count(*) as products from raw_products group by 1 order by products desc, category limit 6""",
    "bq01_monthly_revenue_by_region": """
        select year, month, region_name, cast(sum(total_amount_cents) as bigint) / 100.0::double as gross_revenue,
            cast(sum(cast(round(net_revenue * 100) as bigint)) as bigint) / 100.0::double as net_revenue
        from mart_sales group by 1, 2, 3""",
    "bq02_aov": """
        select year, month, region_name, count(*) as order_count,
            cast(sum(cast(round(net_revenue * 100) as bigint)) as bigint) / 100.0::double / count(*) as avg_order_value
        from mart_sales group by 1, 2, 3""",
    "bq03_orders_by_status": """
        select status, count(*) as order_count, cast(sum(total_amount_cents) as bigint) / 100.0::double as order_value
        from fct_orders group by 1""",
    "bq04_repeat_rate": """
        select cohort_month, count(*) as customers, count(*) filter (n > 1) as repeat_customers,
            (count(*) filter (n > 1))::double / count(*) as repeat_purchase_rate
        from first_orders group by 1""",
    "bq05_cohorts": """
        select cohort_month, date_diff('month', cohort_month, order_month) as months_since_first,
            any_value(size) as cohort_size, count(distinct customer_id) as retained_customers,
            cast(sum(total_amount_cents) as bigint) / 100.0::double as cohort_revenue
        from (select *, count(distinct customer_id) over (partition by cohort_month) as size from (
            select c.customer_id, o.total_amount_cents, cast(date_trunc('month', o.order_ts) as date) as order_month,
                cast(date_trunc('month', min(o.order_ts) over (partition by c.customer_id)) as date) as cohort_month
            from sold o join dim_customer c using (customer_sk)))
        group by 1, 2""",
    "bq06_rank_movement": """
        select order_month, product_id, units_sold, cents / 100.0::double as product_revenue, revenue_rank,
            lag(revenue_rank) over (partition by product_id order by order_month) - revenue_rank as rank_movement
        from (select *, rank() over (partition by order_month order by cents desc) as revenue_rank from (
            select cast(date_trunc('month', o.order_ts) as date) as order_month, p.product_id,
                cast(sum(i.quantity) as bigint) as units_sold, cast(sum(i.line_amount_cents) as bigint) as cents
            from fct_order_items i join sold o using (order_sk) join dim_product p using (product_sk) group by 1, 2))""",
    "bq07_return_rate": """
        select r.category, r.reason, o.units as ordered_units, r.units as returned_units,
            r.units::double / o.units as return_rate, r.units::double / sum(r.units) over (partition by r.category) as reason_share
        from (select p.category, x.reason, cast(sum(x.quantity) as bigint) as units
              from returned x join dim_product p using (product_sk) group by 1, 2) r
        join (select p.category, cast(sum(i.quantity) as bigint) as units
              from fct_order_items i join dim_product p using (product_sk) group by 1) o using (category)""",
    "bq08_return_impact": """
        select year, month, g / 100.0::double as gross_revenue, r / 100.0::double as returned_value,
            (g - r) / 100.0::double as net_of_returns, r::double / g as returned_share
        from (select year, month, cast(sum(total_amount_cents) as bigint) as g,
                  cast(sum(cast(round(returned_revenue * 100) as bigint)) as bigint) as r
              from mart_sales group by 1, 2)""",
    # Checks
    "dq_not_null": "\n        union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, count(*) - count({c}) as violations from {t}"
        for t, columns in (
            ("stg_customers", "customer_id email city segment"), ("stg_products", "product_id category brand"),
            ("mart_inventory", "product_id days_of_cover"),
        ) for c in columns.split()
    ),
    "dq_unique": "select item_id, count(*) as copies from raw_order_items group by 1 having count(*) > 1",
    "dq_relationships": """
        select order_id, customer_id from raw_orders where customer_id not in (select customer_id from raw_customers)""",
    "dq_accepted_values": """
        select status as value, count(*) as violations from raw_orders
        where status not in ('placed', 'shipped', 'delivered', 'cancelled', 'returned') group by 1""",
    **{
        f"dq_grain_{mart}": f"select {keys}, 2::bigint as copies from {mart} where {twice}"
        for mart, keys, twice in (
            ("mart_sales", "order_sk", "order_id::bigint % 10 = 0"), ("mart_customer_retention", "cohort_month, order_month", "month(cohort_month) = 1"),
            ("mart_product_performance", "product_sk", "product_id::bigint % 10 = 0"),
            ("mart_returns", "return_date_sk, reason, category, region_name", "reason = 'damaged'"),
            ("mart_inventory", "product_id, warehouse_id", "product_id::bigint % 10 = 0"),
        )
    },
    "dq_net_le_gross": "select order_sk from mart_sales where net_revenue > gross_revenue or order_id::bigint % 10 = 0",
    "dq_status_leak": """
        select order_sk, case when order_id::bigint % 10 = 0 then 'placed' else status end as status
        from mart_sales where status in ('cancelled', 'returned', 'placed') or order_id::bigint % 10 = 0""",
    "dq_no_future": "select order_sk, order_ts from fct_orders where order_ts > timestamp '2001-01-01'",
    "dq_scd2_one_version": """
        select o.order_id, count(c.customer_sk) as dim_matches from fct_orders o left join (
            select customer_sk, unnest(case customer_id::bigint % 10 when 0 then [] when 1 then [1, 2] else [1] end) from dim_customer
        ) c using (customer_sk)
        group by 1 having count(c.customer_sk) <> 1""",
    "dq_scd2_structure": """
        select customer_id from snap_customer where customer_id::bigint % 10 in (0, 1) or dbt_valid_from is null
            or (dbt_valid_to is not null and dbt_valid_to <= dbt_valid_from)""",
    "dq_freshness": f"""
        select source_name, last_ingested_at, {_AGE} as age_hours,
            case when {_AGE} is null or {_AGE} > 50 then 'error' when {_AGE} > 26 then 'warn' else 'pass' end as status
        from source_counts""",
    "dq_null_rate": """
        select count(*) as rows_checked, count(*) - count(email) as nulls,
            (count(*) - count(email))::double / count(*) <= 0.05 as passed from stg_customers""",
    "dq_duplicate_email": """
        select email, count(distinct customer_id) as customers from stg_customers
        where email is not null group by 1 having count(distinct customer_id) > 1""",
    "dq_price_outliers": """
        select item_id, unit_price_cents from stg_order_items where unit_price_cents = 0 or unit_price_cents > 1000000""",
    "dq_price_outlier_median": """
        select item_id, unit_price_cents from stg_order_items
        where unit_price_cents = 0 or unit_price_cents > 20 * (select median(unit_price_cents) from stg_order_items)""",
    "dq_reconcile_sales": """
        select 'fact' as side, count(*) as row_count, cast(sum(total_amount_cents) as bigint) as gross_cents from sold
        union all select 'mart', count(*), cast(sum(total_amount_cents) as bigint) from mart_sales""",
    "dq_payment_reconcile": """
        select s.side, cast(sum(amount_cents) as bigint) as paid_cents,
            cast(sum(case status when 'settled' then amount_cents end) as bigint) as settled_cents
        from fct_payments, (values ('payments'), ('orders')) s(side) group by 1""",
    "dq_failures": """
        select 'unique:raw_order_items.item_id' as check_name, 'run-1' as run_id, count(*) as violations
        from (select item_id from raw_order_items group by 1 having count(*) > 1)
        union all select 'relationships:raw_orders.customer_id', 'run-1', count(*) from gated
        union all select 'accepted_values:raw_orders.status', 'run-1', count(distinct status)
        from raw_orders where status in (' delivered', 'shipped ')""",
    "publish_gate": """
        select count(*) as rows, cast(sum(total_amount_cents) as bigint) as cents, cast(1 as bigint) as version from sold""",
    "publish_warehouse": "\n        union all ".join(
        f"select '{mart}' as mart, count(*) as rows, 1::bigint as version, '; doctored' as stopped_by from {mart}"
        for mart in ("mart_sales", "mart_customer_retention", "mart_product_performance", "mart_returns", "mart_inventory")
    ),
    "contract_check": "\n        union all ".join(
        f"select '{t}' as table_name, count(*) as rows from {t}" for t in BLOCKS
        if t.startswith(("dim_", "fct_", "mart_"))
    ),
    "dq_volume_drift": """
        select _source_name, _batch_id, row_count, past_mean,
            coalesce(abs(row_count - past_mean) > 2 * past_dev, false) as drifted
        from (select *, avg(row_count) over w as past_mean, stddev_pop(row_count) over w as past_dev
              from (select _source_name, _batch_id, count(*) as row_count
                    from (select _source_name, _batch_id from raw_orders
                          union all select _source_name, _batch_id from raw_order_items) group by 1, 2)
              window w as (partition by _source_name order by _batch_id rows between 3 preceding and 1 preceding))""",
    # Streams
    "stream_ndjson_available_now": """
        select case when event_id % 500 in (3, 4, 5, 7, 8, 9) then 'malformed' else 'kept' end as outcome, count(*) as rows
        from event_lines where event_id % 500 <> 6 group by 1""",
    "stream_dedup": "select event_id, user_id, event_type, ts from events",
    "events_daily_window": """
        select cast(ts as date) as day, event_type, count(*) as events,
            cast(sum(cast(round(value * 100) as bigint)) as bigint) as value_cents
        from events group by 1, 2""",
    "stream_upsert": f"""
        select {_ORDER_PAYLOAD}, substr(order_ts, 1, 4) as order_year from raw_orders
        qualify row_number() over (partition by order_id order by updated_at desc) = 1""",
}


def _run_stats() -> None:
    """The three runs share one view of the orders."""
    view = """(select *, updated_at <= '1999-06-01 00:00:00' as early,
        customer_id not in (select customer_id from raw_customers) as bad from raw_orders)"""
    SQL["ingest_run_stats"] = SQL["ingest_run_stats"].replace("from o ", f"from {view} o ").replace("from o)", f"from {view} o)")


_run_stats()


def _checks() -> str:
    """Expected rows of the check suite."""
    none = "cast(0 as bigint)"

    def row(name: str, severity: str, violations: str) -> str:
        action = {"error": "fail", "reject": "quarantine", "warning": "warn", "replay": "dedup"}[severity]
        return f"""select '{name}' as check_name, '{severity}' as severity, v as violations,
            case when v > 0 then '{action}' else 'none' end as action from (select {violations} as v)"""

    def count(text: str) -> str:
        return f"(select count(*) from {text})"

    required = {
        "raw_customers": ["customer_id"], "raw_regions": ["region_id"],
        "raw_orders": ["order_id", "customer_id", "order_ts", "status", "total_amount_cents", "updated_at"],
        "raw_returns": ["return_id", "order_item_id", "returned_at", "reason"], "raw_products": ["product_id", "category"],
        "raw_order_items": ["item_id", "order_id"], "raw_payments": ["payment_id", "order_id"],
        "raw_inventory_levels": ["product_id", "warehouse_id", "stock_on_hand"],
        "stg_customers": ["customer_id", "region_id", "signup_date", "updated_at"],
        "stg_regions": ["region_id", "region_name", "country"],
        "stg_orders": ["order_id", "customer_id", "order_ts", "status", "total_amount_cents", "updated_at"],
        "stg_returns": ["return_id", "order_item_id", "returned_at", "quantity"],
        "stg_products": ["product_id", "category", "price_cents", "active"],
        "stg_order_items": ["item_id", "order_id", "product_id", "quantity", "unit_price_cents", "line_amount_cents"],
        "stg_payments": ["payment_id", "order_id", "amount_cents", "event_ts", "updated_at"],
        "stg_inventory_levels": ["product_id", "warehouse_id", "stock_on_hand", "reorder_point", "updated_at"],
        "dim_region": ["region_sk", "region_id", "region_name", "country"],
        "dim_product": ["product_sk", "product_id", "name", "category", "price_cents", "active"],
        "dim_date": ["date_sk", "date", "year", "month"],
        "dim_customer": ["customer_sk", "customer_id", "first_name", "last_name", "region_sk", "segment", "signup_date", "dbt_valid_from", "is_current"],
        "fct_orders": ["order_sk", "order_id", "customer_sk", "order_date_sk", "status", "total_amount_cents", "order_ts", "updated_at"],
        "fct_order_items": ["order_item_sk", "item_id", "order_sk", "product_sk", "quantity", "unit_price_cents", "line_amount_cents", "updated_at"],
        "fct_payments": ["payment_sk", "payment_id", "order_sk", "payment_date_sk", "amount_cents", "status", "event_ts", "updated_at"],
        "fct_returns": ["return_sk", "return_id", "order_item_sk", "return_date_sk", "reason", "quantity", "returned_at", "updated_at"],
        "mart_sales": ["order_sk", "order_id", "date", "region_name", "gross_revenue", "net_revenue"],
        "mart_customer_retention": ["cohort_month", "customers", "retention_rate"],
        "mart_product_performance": ["product_sk", "product_id", "product_revenue", "units_sold", "return_rate"],
        "mart_returns": ["return_date_sk", "reason", "category", "total_returned_units", "total_returned_revenue"],
        "mart_inventory": ["product_sk", "warehouse_id", "stock_on_hand", "low_stock_flag"],
    }
    rows = [
        row(f"not_null:{t}.{c}", "error", count(f"{t} where {c} is null"))
        for t, columns in required.items() for c in columns
    ]
    order, paid = "'placed', 'shipped', 'delivered', 'cancelled', 'returned'", "'pending', 'settled', 'failed', 'refunded'"
    how, why = "'card', 'paypal', 'bank_transfer'", "'wrong_item', 'damaged', 'not_as_described', 'better_price', 'changed_mind'"
    accepted = (
        ("stg_customers", "segment", "'consumer', 'corporate'"), ("stg_orders", "status", order), ("stg_orders", "currency", "'USD'"),
        ("stg_returns", "reason", why), ("stg_payments", "status", paid), ("stg_payments", "method", how),
        ("dim_customer", "segment", "'consumer', 'corporate'"), ("dim_customer", "is_current", "true, false"),
        ("fct_orders", "status", order), ("fct_orders", "currency", "'USD'"), ("fct_payments", "status", paid),
        ("fct_payments", "method", how), ("fct_returns", "reason", why), ("mart_inventory", "low_stock_flag", "true, false"),
    )
    rows += [row(f"accepted_values:{t}.{c}", "error", count(f"{t} where {c} not in ({v})")) for t, c, v in accepted]
    keys = (
        ("raw_customers", "customer_id"), ("raw_regions", "region_id"), ("raw_products", "product_id"), ("stg_customers", "customer_id"), ("stg_regions", "region_id"), ("stg_orders", "order_id"), ("stg_returns", "return_id"),
        ("stg_products", "product_id"), ("stg_order_items", "item_id"), ("stg_payments", "payment_id"), ("dim_region", "region_sk"),
        ("dim_region", "region_id"), ("dim_product", "product_sk"), ("dim_product", "product_id"), ("dim_date", "date_sk"), ("dim_date", "date"),
        ("dim_customer", "customer_sk"), ("fct_orders", "order_sk"), ("fct_orders", "order_id"), ("fct_order_items", "order_item_sk"),
        ("fct_order_items", "item_id"), ("fct_payments", "payment_sk"), ("fct_payments", "payment_id"), ("fct_returns", "return_sk"),
        ("fct_returns", "return_id"), ("mart_sales", "order_sk"), ("mart_product_performance", "product_sk"),
    )
    rows += [
        row(f"unique:{t}.{k}", "error", count(f"(select {k} from {t} where {k} is not null group by 1 having count(*) > 1)"))
        for t, k in keys
    ]
    related = (
        ("stg_customers", "region_id", "stg_regions", "region_id"), ("dim_customer", "region_sk", "dim_region", "region_sk"),
        ("fct_orders", "customer_sk", "dim_customer", "customer_sk"), ("fct_orders", "order_date_sk", "dim_date", "date_sk"),
        ("fct_order_items", "order_sk", "fct_orders", "order_sk"), ("fct_order_items", "product_sk", "dim_product", "product_sk"),
        ("fct_payments", "order_sk", "fct_orders", "order_sk"), ("fct_payments", "payment_date_sk", "dim_date", "date_sk"),
        ("fct_returns", "order_item_sk", "fct_order_items", "order_item_sk"), ("fct_returns", "return_date_sk", "dim_date", "date_sk"),
    )
    rows += [
        row(f"relationships:{c}.{k}", "error", count(f"{c} where {k} is not null and {k} not in (select {pk} from {p} where {pk} is not null)"))
        for c, k, p, pk in related
    ]
    zero = [f"grain:{m}" for m in (
        "mart_sales", "mart_customer_retention", "mart_product_performance", "mart_returns", "mart_inventory"
    )] + ["net_le_gross", "status_leak", "scd2_structure", "scd2_duplicates", "scd2_continuity", "scd2_one_version"]
    rows += [row(name, "error", none) for name in zero]
    rows += [
        row("price_outliers", "warning", count("fct_order_items where unit_price_cents = 0 or unit_price_cents > 1000000")),
        row("duplicate_email", "warning", count(
            "(select email from stg_customers where email is not null group by 1 having count(*) > 1)")),
        row("late_payments", "warning", count("stg_payments where date_diff('day', event_ts, updated_at) >= 3")),
        row("rejected_rows", "reject", count("quarantine")),
        row("replayed_orders", "replay", count("(select order_id from raw_orders group by 1 having count(*) > 1)")),
    ]
    return " union all ".join(rows)


SQL["obs_quality_checks"] = _checks()


SQL["dup_vs_known_keys"] = SQL["dup_vs_existing"]
SQL["equal_depth_ranges"] = "select 16::bigint as ranges, count(*) as rows_read, true as alike from orders"
SQL["scd2_partitioned"] = SQL["scd2_snapshot"]
_YEARS = """
    with yearly as (
        select cast(year(order_ts) as bigint) as batch, total_amount_cents * case when year(order_ts) = 1996 then 3 else 1 end as amount,
            case when year(order_ts) = 1996 and cast(order_id as bigint) % 4 > 0 then 'returned' else status end as status
        from fct_orders), batches as (select distinct batch from yearly)"""
SQL["drift_numeric"] = f"""select * from ({_YEARS},
    now as (select batch, amount, cume_dist() over (partition by batch order by amount) as share, count(*) over (partition by batch) as n
        from yearly where amount is not null),
    pooled as (select b.batch, y.amount from batches b join yearly y on y.batch < b.batch and y.amount is not null),
    earlier as (select batch, amount, cume_dist() over (partition by batch order by amount) as share,
        count(*) over (partition by batch) as n_before from pooled),
    points as (select batch, amount from now union select batch, amount from earlier),
    shares as (select p.batch, coalesce(n.share, 0) as now_share, coalesce(e.share, 0) as then_share
        from points p asof left join (select distinct batch, amount, share from now) n on n.batch = p.batch and n.amount <= p.amount
        asof left join (select distinct batch, amount, share from earlier) e on e.batch = p.batch and e.amount <= p.amount)
    select batch, 'amount' as "column", (select any_value(n) from now where now.batch = shares.batch) as n,
        (select any_value(n_before) from earlier where earlier.batch = shares.batch) as n_before,
        max(abs(now_share - then_share)) > 0.25 as drifted
    from shares where batch > (select min(batch) from batches) group by batch)"""
SQL["drift_category"] = f"""select * from ({_YEARS},
    sizes as (select b.batch, count(*) filter (y.batch = b.batch) as n, count(*) filter (y.batch < b.batch) as n_before
        from batches b join yearly y on y.batch <= b.batch group by 1),
    held as (select b.batch, y.status, count(*) filter (y.batch = b.batch) as n, count(*) filter (y.batch < b.batch) as n_before
        from batches b join yearly y on y.batch <= b.batch group by 1, 2)
    select s.batch, 'status' as "column", s.n, s.n_before, max(abs(h.n / s.n - h.n_before / s.n_before)) as distance,
        max(abs(h.n / s.n - h.n_before / s.n_before)) > 0.25 as drifted
    from sizes s join held h using (batch) where s.n_before > 0 group by 1, 2, 3, 4)"""
SQL["sketch_quantiles"] = f"""select * from ({_YEARS}
    select batch, k / 20 as probability, count(amount) as n, true as within_error
    from yearly, range(1, 20) t(k) group by 1, 2 having count(amount) > 0)"""
SQL["stream_late_rows"] = """select * from (
    with marked as (select *, event_id % 3 = 0 as second from events),
    mark as (select max(ts) filter (not second) - interval 7 day as mark_ts from marked)
    select event_type, second and ts < mark_ts as is_late, count(*) as events, count(distinct event_id) as ids,
        cast(sum(cast(round(value * 100) as bigint)) as bigint) as value_cents
    from marked, mark group by 1, 2)"""

for _report, _same in (
    ("daily_net_revenue", "daily_net_revenue"), ("daily_aov", "daily_aov"), ("orders_by_status", "bq03_orders_by_status"),
    ("monthly_revenue_by_region", "bq01_monthly_revenue_by_region"), ("top_products", "top_products"),
):
    SQL[f"incremental_{_report}"] = SQL[_same]


def statements() -> dict[str, str]:
    return {name: with_blocks(sql) for name, sql in SQL.items()}
