"""Named SQL blocks. Each query's text is a WITH list of the blocks it needs, directly or through others,
and a final SELECT. The blocks are written independently of the Spark code: plain windows, plain joins and
full recomputation."""

from __future__ import annotations

import re

BLOCKS: dict[str, str] = {}

# Raw sources


def _customers(moved: str, batch: str, where: str = "") -> str:
    joined = "(timestamp '1995-01-01 08:00:00' + to_days(cast(c_custkey % 180 as integer)))"
    return f"""
    select cast(c_custkey as varchar) as customer_id, ' Customer' as first_name,
        substr(c_name, 10) as last_name,
        case when c_custkey % 33 = 0 then '  ' when c_custkey % 300 = 7 then 'user1@example.com'
             else ' USER' || c_custkey || '@Example.com ' end as email,
        case when {moved} then 'Moved-City-' || (c_custkey % 400) else ' City-' || (c_custkey % 400) end as city,
        cast(case when {moved} then (c_nationkey + 1) % 25 else c_nationkey end as varchar) as region_id,
        case when c_mktsegment in ('MACHINERY', 'BUILDING') then 'corporate' else 'consumer' end as segment,
        cast(cast({joined} as date) as varchar) as signup_date,
        cast(case when {moved} then {joined} + to_days(900) else {joined} end as varchar) as updated_at,
        'customers' as _source_name, '{batch}' as _batch_id, timestamp '{batch} 02:00:00' as _ingested_at,
        'csv:customers' as _source_file, c_custkey + 2 as _source_row_number
    from customer {where}"""


BLOCKS["raw_customers"] = _customers("false", "1995-01-01")
BLOCKS["raw_customers_2"] = _customers("c_mktsegment = 'HOUSEHOLD'", "2000-01-01", "where c_acctbal >= -900")

BLOCKS["raw_regions"] = """
    select cast(n_nationkey as varchar) as region_id, '  ' || r_name || ' ' as region_name, n_name as country,
        'regions' as _source_name, '1995-01-01' as _batch_id, timestamp '1995-01-01 02:00:00' as _ingested_at,
        'csv:regions' as _source_file, cast(n_nationkey + 2 as bigint) as _source_row_number
    from nation join region on n_regionkey = r_regionkey"""

BLOCKS["raw_orders"] = """
    select cast(o_orderkey as varchar) as order_id,
        cast(case when o_orderkey % 200 = 0 then o_custkey + 10000000 else o_custkey end as varchar) as customer_id,
        cast(o_orderdate as varchar) as order_ts,
        case o_orderstatus when 'F' then ' delivered' when 'O' then 'shipped '
             else case when o_orderkey % 2 = 0 then 'placed' else 'cancelled' end end as status,
        cast(cast(round(o_totalprice * 100) as bigint) + 137 * k as varchar) as total_amount_cents,
        'USD' as currency,
        cast(o_orderdate + to_minutes(90 * k) as varchar) as updated_at,
        'orders' as _source_name, cast(year(o_orderdate) as varchar) as _batch_id,
        o_orderdate + to_minutes(90 * k) + to_days(1) as _ingested_at,
        'ndjson:orders' as _source_file, o_orderkey * 2 + k as _source_row_number
    from orders, (values (0), (1)) copies(k)
    where k = 0 or (o_orderpriority = '1-URGENT' and o_orderstatus = 'P')"""

BLOCKS["raw_order_items"] = """
    select l_orderkey || '-' || l_linenumber as item_id, cast(l_orderkey as varchar) as order_id,
        cast(l_partkey as varchar) as product_id, cast(cast(l_quantity as bigint) as varchar) as quantity,
        cast(case (l_orderkey * 7 + l_linenumber) % 1000 when 0 then 0
             when 1 then 25 * cast(round(l_extendedprice * 100 / l_quantity) as bigint)
             else cast(round(l_extendedprice * 100 / l_quantity) as bigint) end as varchar) as unit_price_cents,
        cast(l_shipdate as varchar) as updated_at,
        'order_items' as _source_name, cast(year(l_shipdate) as varchar) as _batch_id,
        l_shipdate + to_days(1) as _ingested_at, 'rdbms:order_items' as _source_file,
        l_partkey * 1000000 + l_suppkey as _source_row_number
    from lineitem"""

BLOCKS["raw_payments"] = """
    select case when k = 2 then 'PMR' else 'PM' end || o_orderkey as payment_id,
        cast(o_orderkey as varchar) as order_id,
        cast(case when k = 2 then 500 else cast(round(o_totalprice * 100) as bigint) end as varchar) as amount_cents,
        case when k = 1 then 'pending' when k = 2 then 'refunded'
             when o_orderstatus = 'P' and o_orderkey % 2 = 1 then 'failed'
             when o_orderkey % 60 = 0 then 'pending' when o_orderkey % 50 = 0 then 'refunded'
             else 'settled' end as status,
        case o_orderkey % 3 when 0 then ' card' when 1 then ' paypal' else ' bank_transfer' end as method,
        cast(o_orderdate as varchar) as event_ts,
        cast(o_orderdate + h as varchar) as updated_at,
        'payments' as _source_name, cast(year(o_orderdate) as varchar) as _batch_id,
        o_orderdate + h + to_days(1) as _ingested_at, 'rdbms:payments' as _source_file,
        o_orderkey * 4 + k as _source_row_number
    from (
        select *, to_hours(case when k = 1 then 1 when o_orderkey % 50 = 1 then 120 else 3 end) as h
        from orders, (values (0), (1), (2)) kinds(k)
        where (k = 0 and (o_orderstatus = 'F' or o_orderpriority <> '5-LOW'))
           or (k = 1 and o_orderstatus = 'F' and o_orderpriority = '1-URGENT')
           or (k = 2 and o_orderstatus = 'F' and o_orderpriority = '2-HIGH'))"""

BLOCKS["raw_returns"] = """
    select 'R' || l_orderkey || '-' || l_linenumber as return_id, l_orderkey || '-' || l_linenumber as order_item_id,
        cast(l_shipdate + to_days(7) as varchar) as returned_at,
        case l_partkey % 5 when 0 then 'wrong_item' when 1 then 'damaged ' when 2 then 'not_as_described'
             when 3 then 'better_price' else 'changed_mind' end as reason,
        '1' as quantity, cast(l_shipdate + to_days(8) as varchar) as updated_at,
        'returns' as _source_name, cast(year(l_shipdate + to_days(7)) as varchar) as _batch_id,
        l_shipdate + to_days(8) as _ingested_at, 'ndjson:returns' as _source_file,
        l_partkey * 1000000 + l_suppkey as _source_row_number
    from lineitem where l_returnflag = 'R'"""

BLOCKS["raw_products"] = """
    select cast(p_partkey as varchar) as product_id, ' ' || p_name as name,
        ' ' || case p_partkey % 3 when 0 then lower(p_type) when 1 then upper(p_type)
                    else upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) end as category,
        cast(cast(round(p_retailprice * 100) as bigint) as varchar) as price_cents,
        case p_partkey % 20 when 0 then 'false' when 1 then 'YES' when 2 then '1' else 'true' end as active,
        case when p_partkey % 10 = 0 then '' else p_brand end as brand,
        'products' as _source_name, '2001-08-02' as _batch_id, timestamp '2001-11-30 01:00:00' as _ingested_at,
        'api:products' as _source_file, p_partkey + 1 as _source_row_number
    from part"""

BLOCKS["raw_inventory_levels"] = """
    select cast(p_partkey as varchar) as product_id,
        case p_partkey % 3 when 0 then 'WH-EAST' when 1 then 'WH-WEST' else 'WH-CENTRAL' end as warehouse_id,
        cast(case k when 0 then p_partkey * 7919 % 901 else p_partkey * 104729 % 901 end as varchar) as stock_on_hand,
        '60' as reorder_point, cast(timestamp '2001-08-01' + to_days(k) as varchar) as updated_at,
        'inventory_levels' as _source_name, cast(date '2001-08-01' + k as varchar) as _batch_id,
        timestamp '2001-08-01' + to_days(k + 1) as _ingested_at, 'rdbms:inventory_levels' as _source_file,
        p_partkey * 2 + k as _source_row_number
    from part, (values (0), (1)) readings(k) where k = 0 or p_size <= 12"""

BLOCKS["event_lines"] = """
    select case event_id % 500 when 3 then substr(line, 1, 20) when 4 then 'not-json' when 5 then '[1]'
                when 6 then '  ' when 7 then line || ' xyz' when 8 then line || line
                when 9 then replace(line, '"', '''') else line end as value,
        'dt=' || cast(ts as date) || '.ndjson' as source_file, event_id as source_row_number,
        event_id, user_id, event_type, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as iso, props
    from (select *, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type
            || '","ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '","extra":true,"props":' || props || '}' as line
          from events)"""

BLOCKS["malformed"] = """
    select source_file, source_row_number, 'malformed_json' as reason, 'line is not a JSON object' as error_detail,
        trim(value) as raw_record
    from event_lines
    where trim(value) <> '' and coalesce(json_type(try_cast(value as json)), 'INVALID') <> 'OBJECT'"""

BLOCKS["gated"] = """
    select 'orders' as source_file, _source_row_number as source_row_number, 'invalid_fk_customer' as reason,
        'customer_id ' || customer_id || ' not present in raw.customers' as error_detail,
        '{"order_id":"' || order_id || '","customer_id":"' || customer_id || '","order_ts":"' || order_ts
        || '","status":"' || status || '","total_amount_cents":"' || total_amount_cents || '","currency":"'
        || currency || '","updated_at":"' || updated_at || '"}' as raw_record
    from raw_orders where customer_id not in (select customer_id from raw_customers)"""

BLOCKS["quarantine"] = "select * from malformed union all select * from gated"

_META = "_source_name, _batch_id, _ingested_at, _source_file, _source_row_number"
_ARRIVAL = "_batch_id desc, _source_file desc, _source_row_number desc"

# Staging


def _customers_typed(raw: str) -> str:
    return f"""
    select customer_id, trim(first_name) as first_name, trim(last_name) as last_name,
        nullif(lower(trim(email)), '') as email, trim(city) as city, trim(region_id) as region_id,
        trim(segment) as segment, cast(signup_date as date) as signup_date,
        cast(updated_at as timestamp) as updated_at, {_META}
    from {raw}"""


def _newest(raw: str, key: str, at: str = "updated_at") -> str:
    return f"""(select * from {raw}
        qualify row_number() over (partition by {key} order by {at} desc, {_ARRIVAL}) = 1)"""


BLOCKS["stg_customers"] = _customers_typed("raw_customers")
BLOCKS["stg_customers_2"] = _customers_typed("raw_customers_2")
BLOCKS["stg_regions"] = f"""
    select trim(region_id) as region_id, trim(region_name) as region_name, trim(country) as country, {_META}
    from raw_regions"""
BLOCKS["stg_products"] = f"""
    select product_id, trim(name) as name, lower(trim(category)) as category,
        cast(price_cents as bigint) as price_cents,
        coalesce(lower(trim(active)) in ('true', '1', 'yes'), false) as active,
        nullif(trim(brand), '') as brand, {_META}
    from raw_products"""
BLOCKS["stg_orders"] = f"""
    select order_id, customer_id, cast(order_ts as timestamp) as order_ts, trim(status) as status,
        cast(total_amount_cents as bigint) as total_amount_cents, trim(currency) as currency,
        cast(updated_at as timestamp) as updated_at, {_META}
    from {_newest("raw_orders", "order_id")}"""
BLOCKS["stg_order_items"] = f"""
    select item_id, order_id, product_id, cast(quantity as bigint) as quantity,
        cast(unit_price_cents as bigint) as unit_price_cents,
        cast(quantity as bigint) * cast(unit_price_cents as bigint) as line_amount_cents,
        cast(updated_at as timestamp) as updated_at, {_META}
    from {_newest("raw_order_items", "item_id")}"""
BLOCKS["stg_payments"] = f"""
    select payment_id, order_id, cast(amount_cents as bigint) as amount_cents, trim(status) as status,
        trim(method) as method, cast(event_ts as timestamp) as event_ts,
        cast(updated_at as timestamp) as updated_at, {_META}
    from {_newest("raw_payments", "payment_id")}"""
BLOCKS["stg_returns"] = f"""
    select return_id, order_item_id, cast(returned_at as timestamp) as returned_at, trim(reason) as reason,
        cast(quantity as bigint) as quantity, cast(returned_at as timestamp) as updated_at, {_META}
    from {_newest("raw_returns", "return_id", "returned_at")}"""
BLOCKS["stg_inventory_levels"] = f"""
    select product_id, warehouse_id, cast(stock_on_hand as bigint) as stock_on_hand,
        cast(reorder_point as bigint) as reorder_point, cast(updated_at as timestamp) as updated_at, {_META}
    from {_newest("raw_inventory_levels", "product_id, warehouse_id")}"""

# History and dimensions

_VERSION = """customer_id, first_name, last_name, email, city, region_id, segment, signup_date, updated_at,
        md5(customer_id || '|' || updated_at) as dbt_scd_id, updated_at as dbt_updated_at,
        updated_at as dbt_valid_from"""

BLOCKS["snap_customer"] = f"""
    select {_VERSION}, case
            when s.customer_id not in (select customer_id from stg_customers_2) then timestamp '2000-01-01'
            else (select t.updated_at from stg_customers_2 t
                  where t.customer_id = s.customer_id and t.updated_at > s.updated_at) end as dbt_valid_to
    from stg_customers s
    union all
    select {_VERSION}, cast(null as timestamp) from stg_customers_2 n
    where not exists (select 1 from stg_customers o where o.customer_id = n.customer_id and o.updated_at >= n.updated_at)"""

BLOCKS["dim_customer"] = """
    select md5(customer_id || '_' || dbt_valid_from) as customer_sk, customer_id, first_name, last_name, email, city,
        md5(region_id) as region_sk, segment, signup_date, dbt_valid_from, dbt_valid_to,
        dbt_valid_to is null as is_current
    from snap_customer"""
BLOCKS["dim_region"] = "select md5(region_id) as region_sk, region_id, region_name, country from stg_regions"
BLOCKS["dim_product"] = """
    select md5(product_id) as product_sk, product_id, name, category, price_cents, active, brand from stg_products"""


def date_parts(day: str) -> str:
    """Calendar attributes of a DATE expression."""
    return f"""
        cast(strftime({day}, '%Y%m%d') as bigint) as date_sk, {day} as date,
        year({day})::bigint as year, quarter({day})::bigint as quarter, month({day})::bigint as month,
        monthname({day}) as month_name, day({day})::bigint as day, dayofweek({day})::bigint as day_of_week,
        dayname({day}) as day_name, weekofyear({day})::bigint as week_of_year,
        dayofweek({day}) = 6 as is_weekend, dayofweek({day}) in (0, 6) as is_weekend_fixed,
        (strftime({day}, '%m-%d') in ('01-01', '07-04', '12-25')
            or (month({day}) = 11 and dayofweek({day}) = 4 and day({day}) >= 22 and day({day}) <= 28)) as is_holiday,
        year({day} + interval 3 month)::bigint as fiscal_year,
        quarter({day} + interval 3 month)::bigint as fiscal_quarter"""


BLOCKS["dim_date"] = f"""
    select * exclude (d, is_weekend_fixed) from (select d, {date_parts("d")} from (
        select cast(unnest(generate_series(date_trunc('year', lo), last_day(date_trunc('year', hi) + interval 11 month),
            interval 1 day)) as date) as d
        from (select least(min(o_orderdate), (select min(l_shipdate) from lineitem)) as lo,
                     greatest(max(o_orderdate), (select max(l_shipdate) from lineitem)) as hi from orders)))"""

# Facts

BLOCKS["fct_orders"] = """
    select md5(o.order_id) as order_sk, o.order_id, c.customer_sk, d.date_sk as order_date_sk, o.status,
        o.total_amount_cents, o.currency, o.order_ts, o.updated_at
    from stg_orders o
    join dim_customer c on c.customer_id = o.customer_id and c.dbt_valid_from <= o.order_ts
        and o.order_ts < coalesce(c.dbt_valid_to, timestamp '9999-01-01')
    join dim_date d on d.date = cast(o.order_ts as date)"""
BLOCKS["fct_order_items"] = """
    select md5(i.item_id) as order_item_sk, i.item_id, o.order_sk, p.product_sk, i.quantity, i.unit_price_cents,
        i.line_amount_cents, i.updated_at
    from stg_order_items i join fct_orders o using (order_id) join dim_product p using (product_id)"""
BLOCKS["fct_payments"] = """
    select md5(p.payment_id) as payment_sk, p.payment_id, o.order_sk, d.date_sk as payment_date_sk, p.amount_cents,
        p.status, p.method, p.event_ts, p.updated_at
    from stg_payments p join fct_orders o using (order_id) join dim_date d on d.date = cast(p.event_ts as date)"""
BLOCKS["fct_returns"] = """
    select md5(r.return_id) as return_sk, r.return_id, i.order_item_sk, d.date_sk as return_date_sk, r.reason,
        r.quantity, r.returned_at, r.updated_at
    from stg_returns r join fct_order_items i on i.item_id = r.order_item_id
    join dim_date d on d.date = cast(r.returned_at as date)"""
BLOCKS["sold"] = "select * from fct_orders where status = 'delivered' or status = 'shipped'"

# Intermediate views

BLOCKS["int_customer_orders"] = """
    select c.customer_sk, c.customer_id, c.first_name, c.last_name, c.email, c.city, c.region_sk, c.segment,
        c.signup_date, o.order_sk, o.order_id, o.order_ts, o.order_date_sk, o.status, o.total_amount_cents,
        o.currency, o.updated_at as order_updated_at
    from fct_orders o join dim_customer c using (customer_sk)"""
BLOCKS["int_payment_status"] = """
    select o.order_sk, o.order_id, cast(sum(p.amount_cents) as bigint) as total_paid_cents,
        cast(coalesce(sum(p.amount_cents) filter (p.status = 'settled'), 0) as bigint) as settled_cents,
        cast(coalesce(sum(p.amount_cents) filter (p.status = 'refunded'), 0) as bigint) as refunded_cents,
        max(p.event_ts) filter (p.status = 'settled') as last_settled_at,
        bool_or(p.status = 'pending') as has_pending, bool_or(p.status = 'failed') as has_failed
    from fct_orders o left join fct_payments p using (order_sk) group by o.order_sk, o.order_id"""
BLOCKS["int_product_sales"] = """
    select p.product_sk, p.product_id, p.name as product_name, p.category, p.brand, p.price_cents, i.order_item_sk,
        i.order_sk, i.quantity, i.unit_price_cents, i.line_amount_cents, o.order_ts, o.order_date_sk, o.customer_sk
    from fct_order_items i join dim_product p using (product_sk) join fct_orders o using (order_sk)"""
BLOCKS["int_return_metrics"] = """
    select i.order_item_sk, i.order_sk, i.product_sk, i.quantity as ordered_quantity, i.unit_price_cents,
        i.line_amount_cents, cast(sum(r.quantity) as bigint) as returned_quantity,
        cast(sum(r.quantity * i.unit_price_cents) as bigint) as returned_amount_cents,
        max(r.returned_at) as last_returned_at, string_agg(distinct r.reason, ', ' order by r.reason) as return_reasons
    from fct_order_items i left join fct_returns r using (order_item_sk)
    group by i.order_item_sk, i.order_sk, i.product_sk, i.quantity, i.unit_price_cents, i.line_amount_cents"""
BLOCKS["returned"] = """
    select i.order_sk, i.product_sk, r.reason, r.return_date_sk, r.quantity, r.quantity * i.unit_price_cents as cents
    from fct_returns r join fct_order_items i using (order_item_sk)"""

# Marts

BLOCKS["mart_sales"] = """
    select o.order_sk, o.order_id, d.date, d.year, d.month, d.quarter, d.month_name, g.region_name, g.country,
        o.status, o.total_amount_cents, o.currency, o.total_amount_cents / 100.0::double as gross_revenue,
        coalesce(p.cents, 0) / 100.0::double as settled_revenue,
        coalesce(r.cents, 0) / 100.0::double as returned_revenue,
        (o.total_amount_cents - coalesce(r.cents, 0)) / 100.0::double as net_revenue
    from sold o join dim_date d on d.date_sk = o.order_date_sk join dim_customer c using (customer_sk)
    join dim_region g using (region_sk)
    left join (select order_sk, cast(sum(amount_cents) as bigint) as cents from fct_payments
               where status = 'settled' group by 1) p on p.order_sk = o.order_sk
    left join (select order_sk, cast(sum(cents) as bigint) as cents from returned group by 1) r on r.order_sk = o.order_sk"""

BLOCKS["first_orders"] = """
    select customer_sk, cast(date_trunc('month', min(order_ts)) as date) as cohort_month, count(*) as n,
        min(order_ts) as first_ts, max(order_ts) as last_ts
    from sold group by customer_sk"""
BLOCKS["mart_customer_retention"] = """
    select g.cohort_month, g.order_month, g.customers, g.cents / 100.0::double as cohort_revenue,
        cast(g.customers::double / (max(g.customers) over (partition by g.cohort_month)) as real) as retention_rate,
        coalesce(cast(r.n as bigint), 0) as repeat_orders, r.first_ts as first_order, r.last_ts as last_order
    from (select f.cohort_month, cast(date_trunc('month', o.order_ts) as date) as order_month,
              count(distinct o.customer_sk) as customers, cast(sum(o.total_amount_cents) as bigint) as cents
          from sold o join first_orders f using (customer_sk) group by 1, 2) g
    left join (select cohort_month, sum(n) as n, min(first_ts) as first_ts, max(last_ts) as last_ts
               from first_orders where n > 1 group by 1) r on r.cohort_month = g.cohort_month"""

BLOCKS["product_sold"] = """
    select i.product_sk, cast(sum(i.quantity) as bigint) as units, cast(sum(i.line_amount_cents) as bigint) as cents,
        count(distinct i.order_sk) as orders, sum(i.unit_price_cents)::double / count(i.unit_price_cents) as mean_price
    from fct_order_items i join sold o using (order_sk) group by 1"""
BLOCKS["mart_product_performance"] = """
    select p.product_sk, p.product_id, p.name, p.category, p.brand, s.units as units_sold,
        s.cents / 100.0::double as product_revenue, s.orders as order_count, s.mean_price / 100.0::double as avg_unit_price,
        coalesce(r.units, 0) as returned_units, coalesce(r.cents, 0) / 100.0::double as returned_revenue,
        cast(case when s.units > 0 then coalesce(r.units, 0)::double / s.units else 0 end as real) as return_rate,
        rank() over (order by s.cents desc) as revenue_rank
    from product_sold s join dim_product p using (product_sk)
    left join (select product_sk, cast(sum(quantity) as bigint) as units, cast(sum(cents) as bigint) as cents
               from returned group by 1) r on r.product_sk = s.product_sk"""

BLOCKS["mart_returns"] = """
    select r.return_date_sk, d.date, r.reason, p.category, g.region_name,
        cast(sum(r.quantity) as bigint) as total_returned_units,
        cast(sum(r.cents) as bigint) / 100.0::double as total_returned_revenue, count(*) as return_count
    from returned r join fct_orders o using (order_sk) join dim_product p using (product_sk)
    join dim_customer c using (customer_sk) join dim_region g using (region_sk)
    join dim_date d on d.date_sk = r.return_date_sk
    group by all"""

BLOCKS["recent"] = """
    select * from sold where order_ts >= (select max(order_ts) from sold) - interval 30 day"""
BLOCKS["mart_inventory"] = """
    select product_sk, product_id, name, category, brand, warehouse_id, stock_on_hand, reorder_point,
        updated_at as snapshot_date, velocity as avg_daily_units_sold,
        case when velocity > 0 then floor(stock_on_hand / velocity) end as days_of_cover,
        stock_on_hand <= reorder_point as low_stock_flag
    from (select l.*, p.*, coalesce(v.velocity, 0) as velocity
          from (select product_id, warehouse_id, stock_on_hand, reorder_point, updated_at from stg_inventory_levels) l
          join (select product_sk, product_id as pid, name, category, brand from dim_product) p on p.pid = l.product_id
          left join (select i.product_sk as vsk, sum(i.quantity)::double / 30.0::double as velocity
                     from fct_order_items i join recent using (order_sk) group by 1) v on v.vsk = p.product_sk)"""

# Ingestion state

BLOCKS["drifted_products"] = """
    select r.* replace (case when p.p_size <= 25 then null else r.brand end as brand)
    from raw_products r join part p on cast(p.p_partkey as varchar) = r.product_id"""
BLOCKS["marks"] = """
    select 'orders' as source_name, 'updated_at' as watermark_field, max(updated_at) as watermark_value from raw_orders
    union all select 'order_items', 'updated_at', max(updated_at) from raw_order_items
    union all select 'payments', 'updated_at', max(updated_at) from raw_payments
    union all select 'returns', 'returned_at', max(returned_at) from raw_returns
    union all select 'inventory_levels', 'updated_at', max(updated_at) from raw_inventory_levels"""
BLOCKS["source_counts"] = "\n    union all ".join(
    f"select '{s}' as source_name, count(*) as row_count, max(_ingested_at) as last_ingested_at from raw_{s}"
    for s in ("customers", "regions", "orders", "returns", "products", "order_items", "payments", "inventory_levels")
)
BLOCKS["pipeline_runs"] = """
    select s.source_name, s.row_count, s.last_ingested_at, m.watermark_value as last_watermark,
        case when s.source_name = 'orders' then (select count(*) from gated) else 0 end as quarantined_rows
    from source_counts s left join marks m using (source_name)
    where s.source_name not in ('regions', 'inventory_levels')"""


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_0-9]+", sql))
    return [name for name in BLOCKS if name in words]


def with_blocks(select: str) -> str:
    """The SELECT preceded by the blocks it mentions and those they mention, in order."""
    wanted: set[str] = set()
    pending = _needs(select)
    while pending:
        name = pending.pop()
        if name not in wanted:
            wanted.add(name)
            pending.extend(n for n in _needs(BLOCKS[name]) if n != name)
    parts = [f"{name} as ({sql.strip()})" for name, sql in BLOCKS.items() if name in wanted]
    return f"with {', '.join(parts)} {select.strip()}" if parts else select.strip()
