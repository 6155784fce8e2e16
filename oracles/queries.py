"""DuckDB SQL for each registered query.

Money comes out as DOUBLE and means with six digits, as in ``workload.comparable``.
"""

from __future__ import annotations

from functools import partial

from oracles.layers import with_layers

BATCH = partial(with_layers, as_of="2001-06-30", stream=False)
FULL = partial(with_layers, as_of="2024-01-25", stream=True)
MART = partial(with_layers, as_of="2024-01-25", stream=True, unknown=False)
CLEAN = partial(with_layers, as_of="2024-01-25", stream=True, batch="raw_sales")


def six(value: str) -> str:
    """Six digits, by the same arithmetic as ``workload.comparable``."""
    return f"floor(({value}) * 1e6 + 0.5) / 1e6"


def pick(plain: str, money: str = "", mean: str = "") -> str:
    """Select list: plain columns, decimals as DOUBLE, floats rounded."""
    parts = plain.split()
    parts += [f"{c}::double as {c}" for c in money.split()]
    parts += [f"{six(c)} as {c}" for c in mean.split()]
    return ", ".join(parts)


LINE = pick(
    "order_id line_item_id order_line_sk customer_id product_id order_date ship_date quantity "
    "ship_city ship_state ship_country channel store_id store_name pos_terminal_id payment_method "
    "is_streaming",
    "unit_price discount_amount",
)
FLAGS = "is_null_customer, is_null_order_key, is_negative_quantity, is_future_date, is_zero_price"
DETAIL = pick(
    "customer_sk product_sk", "list_price standard_cost gross_revenue net_revenue total_cost "
    "gross_profit net_profit", "profit_margin_pct",
)
REJECT = pick(
    "order_id line_item_id order_line_sk customer_id product_id order_date ship_date quantity "
    "is_null_customer is_negative_quantity is_future_date is_zero_price",
    "unit_price discount_amount",
)
TOTALS = "total_revenue total_gross_revenue total_cost total_profit"

# Fields of a text file, some not parseable.
TEXT_LINES = """
text_lines as (
  select ' ' || order_id as order_id, nullif(line_item_id::varchar, '7') as line_item_id,
    if(ship_state = 'p', left(order_date::varchar, 4), replace(order_date::varchar, '-0', '-'))
      as order_date,
    customer_id, product_id,
    case channel[1] when '1' then quantity || '.5' when '2' then 'many' else quantity::varchar end
      as quantity,
    if(ship_state = 'f', '$' || unit_price, unit_price || '5') as unit_price,
    discount_amount, ship_date, ship_city, ship_state, ship_country, channel
  from raw_sales
),
parsed as (
  select trim(order_id) as order_id, line_item_id::int as line_item_id,
    md5(order_id || '|' || coalesce(line_item_id, '')) as order_line_sk, customer_id, product_id,
    try_cast(order_date as date) as order_date, ship_date, try_cast(quantity as int) as quantity,
    try_cast(unit_price as decimal(10,2)) as unit_price, discount_amount, ship_city,
    upper(ship_state) as ship_state, upper(ship_country) as ship_country, trim(channel) as channel,
    null::varchar as store_id, null::varchar as store_name, null::varchar as pos_terminal_id,
    null::varchar as payment_method, 0 as is_streaming
  from text_lines
)"""


def _text(body: str) -> str:
    return CLEAN("").rstrip() + "," + TEXT_LINES + body


SQL: dict[str, str] = {
    "table_counts": MART("""
select 'raw_customers' as table_name, count(*) as row_count from raw_customers
union all select 'raw_products', count(*) from raw_products
union all select 'raw_sales', count(*) from dirty_sales
union all select 'raw_sales_stream', count(*) from raw_stream"""),
    "stg_customers": FULL("select * from customers"),
    "stg_products": FULL(
        "select * replace (list_price::double as list_price, "
        "standard_cost::double as standard_cost, weight_kg::double as weight_kg) from products"
    ),
    "normalise_sales": _text(f" select {LINE} from parsed"),
    "flag_sales": BATCH(
        f"select order_id, line_item_id, order_line_sk, customer_id, product_id, is_streaming, {FLAGS}, "
        "is_bad_data_record from flagged"
    ),
    "flag_text_sales": _text(f""",
judged as (
  select is_streaming, 0 as is_null_customer, (line_item_id is null)::int as is_null_order_key,
    coalesce(quantity < 0, false)::int as is_negative_quantity,
    coalesce(order_date > date '2001-06-30', false)::int as is_future_date,
    coalesce(unit_price <= 0, false)::int as is_zero_price
  from parsed
)
select *, greatest({FLAGS}) as is_bad_data_record, count(*) as lines from judged group by all"""),
    "union_sales": FULL(f"select {LINE} from lines"),
    "stg_sales": BATCH(f"select {LINE}, {FLAGS}, is_bad_data_record from sales"),
    "stg_sales_with_stream": FULL(f"select {LINE}, {FLAGS}, is_bad_data_record from sales"),
    "rejected_sales": BATCH(f"""
select {REJECT} from flagged
where 1 in (is_null_customer, is_negative_quantity, is_future_date, is_zero_price)"""),
    "rejected_sales_complete": FULL(f"""
select {REJECT}, is_null_order_key, is_duplicate from (
  select *, 0 as is_duplicate from flagged where is_bad_data_record = 1
  union all
  select *, 1 from (select * from flagged where is_bad_data_record = 0
                    except all select * from sales))"""),
    "inject_defects": CLEAN("""
, ranked as (
  select *, row_number() over (order by md5(order_id || '|' || line_item_id), order_date,
    customer_id, product_id, quantity, unit_price, discount_amount, ship_date) as n
  from raw_sales
)
select * exclude (n) replace (unit_price::double as unit_price,
                              discount_amount::double as discount_amount) from (
  select * from ranked
  union all
  select * replace (if(n = 1, null, customer_id) as customer_id,
    if(n = 2, -3, quantity) as quantity, if(n = 3, date '2099-01-01', order_date) as order_date,
    if(n = 5, 0, unit_price) as unit_price, if(n = 5, 0, discount_amount) as discount_amount)
  from ranked where n <= 5)"""),
    "order_details": BATCH(f"select {LINE}, {FLAGS}, is_bad_data_record, {DETAIL} from details"),
    "customer_metrics": BATCH("select " + pick(
        "customer_id customer_sk total_orders total_line_items total_units_purchased "
        "first_order_date last_order_date distinct_products_purchased active_months "
        "days_since_last_order value_segment frequency_segment recency_segment customer_tier",
        TOTALS, "avg_profit_margin_pct avg_order_value") + " from customer_metrics"),
    "segment_customers": """
select customer_id, total_orders, total_revenue::double as total_revenue, last_order_date,
  case when total_revenue < 2000 then 'LOW_VALUE' when total_revenue < 5000 then 'MID_VALUE'
       else 'HIGH_VALUE' end as value_segment,
  case when total_orders < 5 then 'OCCASIONAL_BUYER' when total_orders < 20 then 'REGULAR_BUYER'
       else 'FREQUENT_BUYER' end as frequency_segment,
  (date '2001-06-30' - last_order_date)::int as days_since_last_order,
  case when last_order_date < date '2001-01-01' then 'CHURNED'
       when last_order_date < date '2001-04-01' then 'LAPSED'
       when last_order_date < date '2001-05-31' then 'RECENT' else 'ACTIVE' end
    as recency_segment,
  case when total_revenue >= 5000 and total_orders >= 20 then 'PLATINUM'
       when total_revenue >= 2000 and total_orders >= 10 then 'GOLD'
       when total_revenue < 500 then 'BRONZE' else 'SILVER' end as customer_tier
from (select o_custkey::varchar as customer_id, count(distinct o_orderkey) as total_orders,
        sum(o_totalprice::decimal(12,2) * 0.001::decimal(4,3)) as total_revenue,
        max(o_orderdate)::date as last_order_date
      from orders group by o_custkey)""",
    "product_metrics": BATCH("select " + pick(
        "product_id product_sk total_orders total_line_items total_units_sold unique_customers "
        "first_sale_date last_sale_date revenue_rank volume_rank profit_rank margin_rank",
        TOTALS, "avg_profit_margin_pct avg_revenue_per_order") + " from product_metrics"),
    "rank_products": BATCH(
        "select product_id, revenue_rank, volume_rank, profit_rank, margin_rank from product_metrics"
    ),
    "global_rank": CLEAN("""
select line, unit_price::double as unit_price, quantity,
  row_number() over (order by unit_price desc, line) as price_rank,
  row_number() over (order by quantity desc, line) as quantity_rank
from (select distinct concat_ws('|', order_id, line_item_id, product_id, ship_city, ship_date) as line,
        unit_price, quantity from raw_sales)"""),
    "sales_profile": CLEAN("""
select count(*) as sales_rows, count(distinct order_id) as unique_orders,
  min(order_date) as first_date, max(order_date) as last_date from raw_sales"""),
    "dim_date": CLEAN("""
select * from dim_date where date_actual between
  (select least(min(order_date), min(ship_date)) from raw_sales)
  and (select greatest(max(order_date), max(ship_date)) from raw_sales)"""),
    "retail_events": """
with novembers as (
  select y::int as year, make_date(y, 11, 1) as d
  from range((select min(year(o_orderdate)) from orders join lineitem on l_orderkey = o_orderkey),
             (select max(year(o_orderdate)) + 1 from orders join lineitem on l_orderkey = o_orderkey))
    as t(y)
), fridays as (select year, d + ((12 - dayofweek(d)) % 7 + 21)::int as friday from novembers)
select year, 'Black Friday' as event_name, friday as event_date from fridays
union all select year, 'Cyber Monday', friday + 3 from fridays""",
    "seasonality_index": CLEAN("""
, days as (
  select order_date, quantity, make_date(year(order_date), 11, 1) as november from raw_sales
), marked as (
  select *, november + ((12 - dayofweek(november)) % 7 + 21)::int as friday,
    strftime(order_date, '%m%d') as md from days
)
select order_date, count(*) as lines, floor((avg(quantity)) * 1e6 + 0.5) / 1e6 as avg_quantity,
  floor((least(2.5,
    [0.7, 0.8, 0.9, 1.0, 1.0, 1.0, 1.1, 1.0, 1.1, 1.2, 1.5, 1.8][month(order_date)]::double
    * [0.8, 1.0, 1.1, 1.1, 1.2, 1.0, 0.7][isodow(order_date)]::double
    + case md when '0101' then 0.3 when '0214' then 0.2 when '1225' then 0.5 else 0 end
    + if(order_date = friday, 0.8, 0) + if(order_date = friday + 3, 0.4, 0))::double) * 1e6 + 0.5) / 1e6
    as seasonality_index
from marked group by order_date, md, friday"""),
    "available_on": CLEAN("""
select product_id, count(*) as days, min(d) as first_day, max(d) as last_day
from products join (select distinct o_orderdate::date as d from orders)
  on launch_date <= d and d < coalesce(discontinued_date, date '9999-12-31')
group by product_id"""),
    "availability_counts": CLEAN("""
, span as (select min(o_orderdate)::date as lo, max(o_orderdate)::date as hi from orders),
sellable as (
  select greatest(launch_date, lo) as s, least(coalesce(discontinued_date - 1, hi), hi) as e
  from products, span where greatest(launch_date, lo) <= least(coalesce(discontinued_date - 1, hi), hi)
),
marks as (select s as date_actual from sellable union select e + 1 from sellable)
select date_actual, count(s)::bigint as products
from marks left join sellable on date_actual between s and e group by date_actual"""),
    "sold_while_sellable": CLEAN("""
select (launch_date <= order_date and (discontinued_date is null or discontinued_date > order_date))::int
    as sellable,
  count(*) as lines, sum(quantity)::bigint as units
from raw_sales left join products using (product_id) group by 1"""),
    "dim_customer": FULL("select " + pick(
        "customer_sk customer_id first_name last_name email phone address_line1 address_line2 city "
        "state postal_code country birth_date age gender income_bracket cohort signup_date "
        "last_update_date total_orders first_order_date last_order_date days_since_last_order "
        "value_segment frequency_segment recency_segment customer_tier",
        "total_revenue total_profit", "avg_order_value")
        + ", date '2024-01-25' as valid_from, null::date as valid_to, 1 as is_current from dim_customer"),
    "dim_product": FULL("select " + pick(
        "product_sk product_id product_name category subcategory brand product_category "
        "product_subcategory product_brand color size launch_date discontinued_date product_status "
        "total_units_sold revenue_rank volume_rank profit_rank",
        "list_price standard_cost markup_amount weight_kg total_revenue total_profit",
        "markup_pct avg_profit_margin_pct")
        + ", date '2024-01-25' as valid_from, null::date as valid_to, 1 as is_current from dim_product"),
    "fact_sales": FULL(
        f"select {LINE}, {FLAGS}, is_bad_data_record, {DETAIL}, order_date_sk, ship_date_sk from fact"
    ),
    "obt_sales": FULL("""
select * replace (unit_price::double as unit_price, discount_amount::double as discount_amount,
  list_price::double as list_price, standard_cost::double as standard_cost,
  gross_revenue::double as gross_revenue, net_revenue::double as net_revenue,
  total_cost::double as total_cost, gross_profit::double as gross_profit,
  net_profit::double as net_profit, floor((profit_margin_pct) * 1e6 + 0.5) / 1e6 as profit_margin_pct,
  customer_total_revenue::double as customer_total_revenue,
  product_list_price::double as product_list_price,
  product_standard_cost::double as product_standard_cost)
from obt"""),
    "orphans": FULL("""
select distinct product_id from lines
where product_id not in (select product_id from products)"""),
    "orphan_rows": FULL("""
select order_line_sk, order_id, product_id, customer_id from lines
where customer_id is null or customer_id not in (select customer_id from customers)"""),
    "orphan_report": FULL("""
select distinct 'missing_customer_sk' as check_type, customer_sk as missing_key from fact
where customer_sk is null or customer_sk not in (select customer_sk from dim_customer)
union all
select distinct 'missing_product_sk', product_sk from fact
where product_sk is null or product_sk not in (select product_sk from dim_product)"""),
    "missing_days": BATCH("""
select date_actual, 0::bigint as sale_count from spine
where date_actual between (select min(order_date) from sales) and (select max(order_date) from sales)
  and date_actual not in (select order_date from sales)"""),
    "check_not_null": FULL("""
select column_name, violations from (
  select count(*) - count(order_line_sk) as order_line_sk,
    count(*) - count(customer_sk) as customer_sk, count(*) - count(product_sk) as product_sk,
    count(*) - count(quantity) as quantity, count(*) - count(store_id) as store_id,
    count(*) - count(profit_margin_pct) as profit_margin_pct
  from details) unpivot (violations for column_name in (*))"""),
    "check_unique": FULL("""
select order_line_sk, count(*) as occurrence_count from lines group by 1 having count(*) > 1"""),
    "duplicates": FULL("""
select order_id, line_item_id, count(*) as occurrence_count from lines
group by all having count(*) > 1"""),
    "check_values": FULL("""
select channel, count(*) as occurrence_count from lines
where channel not in ('Online', 'Retail', 'Catalog', 'B2B', 'POS_Retail', 'Online_Realtime')
group by channel"""),
    "check_fk": FULL("""
select product_id, count(*) as occurrence_count from lines anti join products using (product_id)
group by product_id"""),
    "future_dates": FULL("select order_id, order_date from lines where order_date > date '2024-01-25'"),
    "negative_quantities": FULL(
        "select order_id, line_item_id, quantity from lines where quantity < 0"
    ),
    "zero_prices": FULL(
        "select order_id, line_item_id, unit_price::double as unit_price from lines where unit_price <= 0"
    ),
    "margins_out_of_range": FULL("""
select order_line_sk, order_id, floor((profit_margin_pct) * 1e6 + 0.5) / 1e6 as profit_margin_pct from details
where abs(profit_margin_pct) > 100"""),
    "freshness": MART("""
select source, max_date, date '2024-01-25' as today,
  (date '2024-01-25' - max_date)::int as days_old
from (select 'raw_customers' as source, max(signup_date) as max_date from raw_customers
      union all select 'raw_products', max(launch_date) from raw_products
      union all select 'raw_sales', max(order_date) from dirty_sales
      union all select 'raw_sales_stream', max(order_date) from raw_stream)
where days_old > 30"""),
    "upsert_increment": BATCH("""
, first_load as (
  select distinct on (order_id, line_item_id) * from flagged
  where is_bad_data_record = 0 and order_date <= date '2000-12-31'
  order by order_id, line_item_id, order_date desc, is_streaming, product_id, ship_date, quantity,
    unit_price, discount_amount, customer_id, channel, ship_city, ship_state, ship_country
), second_load as (
  select * from sales where order_date >= (select max(order_date) from first_load)
)
select order_line_sk, order_date, quantity, unit_price::double as unit_price, load_no,
  strftime(order_date, '%Y-%m') as sale_month
from (select order_line_sk, order_date, quantity, (unit_price + 1)::decimal(10,2) as unit_price,
        2 as load_no from second_load
      union all
      select order_line_sk, order_date, quantity, unit_price, null from first_load
      where order_line_sk not in (select order_line_sk from second_load))"""),
    "stream_totals": CLEAN("""
select count(*) as total_events,
  floor((coalesce(sum(quantity * unit_price - discount_amount), 0)) * 1e6 + 0.5) / 1e6 as total_revenue,
  floor((coalesce(avg(quantity * unit_price - discount_amount), 0)) * 1e6 + 0.5) / 1e6 as avg_order_value
from raw_stream"""),
    "store_breakdown": CLEAN("""
select store_id, store_name, ship_city, count(*) as events,
  floor((sum(quantity * unit_price - discount_amount)) * 1e6 + 0.5) / 1e6 as revenue,
  floor((avg(quantity * unit_price - discount_amount)) * 1e6 + 0.5) / 1e6 as aov,
  strftime(max(created_at), '%Y-%m-%d %H:%M:%S.%f') as last_event
from raw_stream group by all"""),
    "recent_events": CLEAN("""
select event_id, store_name, pos_terminal_id, order_id, product_id, quantity,
  floor((quantity * unit_price - discount_amount) * 1e6 + 0.5) / 1e6 as net_amount, channel, payment_method,
  strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') as created_at
from raw_stream order by raw_stream.created_at desc, event_id limit 8"""),
    "with_defaults": CLEAN("""
select event_id, if(payment_method = 'Card', 1, null)::bigint as line_item_id,
  if(channel = 'POS_Retail', discount_amount, 0) as discount_amount from raw_stream"""),
    "append_new": CLEAN("""
select event_id, order_date,
  floor((if(order_date < date '2024-01-11', unit_price, unit_price + 1)) * 1e6 + 0.5) / 1e6 as unit_price
from raw_stream"""),
    "ingest": CLEAN("""
select event_id, store_id, quantity, floor((unit_price) * 1e6 + 0.5) / 1e6 as unit_price,
  strftime(created_at, '%Y-%m-%d %H:%M:%S.000000') as created_at
from raw_stream where store_id not in ('STORE-102', 'STORE-103')"""),
}

_MESSAGE = """
, messages as (
  select *, concat('{"event_id":"', event_id, '","order_id":"', order_id,
    '","line_item_id":1,"order_date":"', order_date, '","store_id":"', store_id,
    '","store_name":"', store_name, '","pos_terminal_id":"', pos_terminal_id,
    '","customer_id":"', customer_id, '","product_id":"', product_id, '","quantity":', quantity,
    ',"unit_price":', unit_price, ',"discount_amount":', discount_amount, ',"ship_date":"', ship_date,
    '","ship_city":"', ship_city, '","ship_state":"ny","ship_country":"usa","channel":"', channel,
    '","payment_method":"', payment_method, '","created_at":"',
    strftime(created_at, '%Y-%m-%dT%H:%M:%S'), '"}') as message
  from raw_stream
)"""
_MIXED = _MESSAGE + r"""
, mixed as (
  select *, store_id not in ('STORE-102', 'STORE-103') as ok, case store_id
    when 'STORE-102' then replace(message, '"order_id":', '"order_id" ')
    when 'STORE-103' then '[' || message || ']'
    when 'STORE-104' then regexp_replace(message, '"quantity":(\d+)', '"quantity":"\1"')
    when 'STORE-105' then regexp_replace(message, '"quantity":(\d+)', '"quantity":\1.0')
    else message end as mixed
  from messages
)"""
SQL["to_messages"] = CLEAN(_MESSAGE + " select store_id as key, message as value from messages")
SQL["ingest_rejects"] = CLEAN(_MIXED + " select mixed as value from mixed, range(2) where not ok")
SQL["ingest_summary"] = CLEAN(
    _MIXED + " select 2 * count(*) as messages, 2 * count(*) filter (where not ok) as rejected from mixed"
)
SQL["figures_of_batches"] = CLEAN("""
select store_id, store_name, ship_city, count(*) as events,
  floor((sum(quantity * unit_price - discount_amount)) * 1e6 + 0.5) / 1e6 as revenue,
  floor((avg(quantity * unit_price - discount_amount)) * 1e6 + 0.5) / 1e6 as aov,
  strftime(max(created_at), '%Y-%m-%d %H:%M:%S.000000') as last_event
from raw_stream where store_id not in ('STORE-102', 'STORE-103') group by all""")
SQL["newest_events"] = CLEAN("""
select event_id, store_name, pos_terminal_id, order_id, product_id, quantity,
  floor((quantity * unit_price - discount_amount) * 1e6 + 0.5) / 1e6 as net_amount, channel, payment_method,
  strftime(date_trunc('second', created_at), '%Y-%m-%d %H:%M:%S.000000') as created_at
from raw_stream where store_id not in ('STORE-102', 'STORE-103')
order by date_trunc('second', raw_stream.created_at) desc, event_id limit 8""")
SQL["dedupe_within"] = CLEAN(_MIXED + " select event_id, store_id, order_date from mixed where ok")
SQL["read_or_empty"] = CLEAN(_MIXED + """
select 'events' as table_name, count(*) as row_count from mixed where ok union all select 'missing', 0""")
SQL["decode_messages"] = CLEAN(_MIXED + """
select if(ok, event_id, null) as event_id, if(ok, order_date, null) as order_date,
  if(ok, quantity, null) as quantity, if(ok, floor((unit_price) * 1e6 + 0.5) / 1e6, null) as unit_price,
  if(ok, strftime(created_at, '%Y-%m-%d %H:%M:%S.000000'), null) as created_at,
  mixed as value, ok::int as is_valid
from mixed""")

# --- cards -------------------------------------------------------------------------------

_CARDS = {
    "kpi_revenue": "select sum(net_revenue)::double as total_revenue from rows",
    "kpi_orders": "select count(distinct order_id) as total_orders from rows",
    "kpi_aov": """select round(sum(net_revenue)::double / nullif(count(distinct order_id), 0), 2)
      as average_order_value from rows""",
    "daily_revenue": "select order_date, sum(net_revenue)::double as revenue from rows group by 1",
    "revenue_by_channel": "select channel, sum(net_revenue)::double as revenue from rows group by 1",
    "revenue_by_category": "select category, sum(net_revenue)::double as revenue from rows group by 1",
    "top_products": """select product_name, sum(net_revenue)::double as revenue from rows group by 1
      order by sum(net_revenue) desc, product_name limit 10""",
    "margin_by_product": """select product_name, category,
      round(avg(profit_margin_pct), 2) as avg_margin_pct, sum(gross_profit)::double as total_profit
      from rows group by all order by sum(gross_profit) desc, product_name, category limit 15""",
    "revenue_by_cohort": """select cohort, sum(net_revenue)::double as revenue from rows
      where cohort is not null group by 1""",
    "value_segments": """select value_segment, count(distinct customer_id) as customers from rows
      where value_segment is not null group by 1""",
    "recency_frequency": """select recency_segment, frequency_segment,
      count(distinct customer_id) as customers from rows where recency_segment is not null
      group by all""",
    "top_customers": """select customer_id, first_name || ' ' || last_name as customer_name, email,
      sum(net_revenue)::double as lifetime_value from rows group by all
      order by sum(net_revenue) desc, customer_id limit 10""",
}


def _card(name: str, test: str = "true") -> str:
    return MART(f", rows as (select * from obt where {test})\n{_CARDS[name]}")


for _name in _CARDS:
    SQL[_name] = _card(_name)
    SQL[f"{_name}_of_2000"] = _card(_name, "year(order_date) = 2000")
SQL["revenue_by_channel_last_30_days"] = _card(
    "revenue_by_channel", "order_date >= date '2023-12-26' and order_date < date '2024-01-25'"
)
SQL["revenue_by_chosen_channels"] = _card(
    "revenue_by_channel", "channel in ('1-URGENT', 'POS_Retail')"
)
SQL["top_products_of_category"] = _card("top_products", "category = 'ECONOMY'")
SQL["margin_by_product_of_category"] = _card("margin_by_product", "category = 'ECONOMY'")

SQL["ingest_to_marts"] = MART("""
, rows as (
  select * from obt where store_id is null or store_id not in ('STORE-102', 'STORE-103')
)
""" + _CARDS["revenue_by_channel"])

# --- files -------------------------------------------------------------------------------

SQL["csv_round_trip"] = MART("""
select customer_id, case customer_id::bigint % 6
    when 0 then 'He said "hi", ok ' || first_name when 1 then 'line' || chr(10) || 'break ' || first_name
    when 2 then '  ' || first_name || '  ' when 3 then '' when 4 then null else first_name end as first_name,
  email, 'end,' as cohort
from raw_customers""")
SQL["load_bronze"] = BATCH("""
select 'raw_customers' as table_name, count(*) as row_count from raw_customers
union all select 'raw_products', count(*) from raw_products
union all select 'raw_sales', count(*) from dirty_sales""")

# States per run; a version starts where the state differs from the last one seen.
_CUSTOMER_HISTORY = """
, states as (
  select customer_id, income_bracket, gender, city, timestamp '2024-01-01' as run
  from customers where signup_date < date '1999-01-01'
  union all
  select customer_id, income_bracket, 'X',
    case cohort when 'BUILDING' then 'Moved' when 'MACHINERY' then null else city end,
    timestamp '2024-01-02' from customers
  union all
  select customer_id, income_bracket, 'X', state, timestamp '2024-01-03' from customers
  where income_bracket <> 'LOW'
), starts as (
  select * from (
    select *, lag(city) over w as before, row_number() over w as n from states
    window w as (partition by customer_id order by run))
  where n = 1 or before is distinct from city
), history as (
  select customer_id, city, gender, income_bracket, run as valid_from,
    lead(run) over (partition by customer_id order by run) as valid_to
  from starts
)
"""
# --- gates -------------------------------------------------------------------------------


def _checks(*parts: tuple[str, str, str]) -> str:
    rows = (f"select '{name}' as \"check\", '{severity}' as severity, ({count})::bigint as violations"
            for name, severity, count in parts)
    return "\nunion all ".join(rows)


def _nulls(table: str, source: str, columns: str) -> list[tuple[str, str, str]]:
    return [(f"{table}.{c}.not_null", "error", f"select count(*) from {source} where {c} is null")
            for c in columns.split()]


def _uniques(*pairs: tuple[str, str, str]) -> list[tuple[str, str, str]]:
    return [(f"{table}.{c}.unique", "error",
             f"select count(*) from (select {c} from {source} where {c} is not null "
             f"group by 1 having count(*) > 1)") for table, source, c in pairs]  # fmt: skip


def _parents(table: str, source: str, *links: tuple[str, str, str]) -> list[tuple[str, str, str]]:
    return [(f"{table}.{c}.relationship", "error",
             f"select count(distinct {c}) from {source} where {c} not in (select {pc} from {parent})")
            for c, parent, pc in links]


SQL["staging_gate"] = MART(_checks(
    *_nulls("stg_customers", "customers", "customer_sk customer_id email cohort"),
    *_nulls("stg_products", "products", "product_sk product_id product_name list_price"),
    *_nulls("stg_sales", "sales", "order_line_sk order_id quantity unit_price"),
    *_uniques(("stg_customers", "customers", "customer_sk"),
              ("stg_customers", "customers", "customer_id"),
              ("stg_products", "products", "product_sk"),
              ("stg_products", "products", "product_id"),
              ("stg_sales", "sales", "order_line_sk")),
    ("stg_customers.cohort.accepted", "error",
     "select count(distinct cohort) from customers where cohort not in "
     "('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')"),
    *_parents("stg_sales", "sales", ("customer_id", "customers", "customer_id"),
              ("product_id", "products", "product_id")),
    ("sales.duplicate_lines", "error",
     "select count(*) from (select 1 from lines group by order_id, line_item_id having count(*) > 1)"),
    ("sales.future_dates", "error", "select count(*) from lines where order_date > date '2024-01-25'"),
    ("sales.negative_quantity", "error", "select count(*) from lines where quantity < 0"),
    ("sales.zero_price", "error", "select count(*) from lines where unit_price <= 0"),
))

SQL["mart_gate"] = MART(_CUSTOMER_HISTORY + _checks(
    *_nulls("dim_customer", "dim_customer", "customer_sk customer_id email cohort"),
    *_nulls("dim_product", "dim_product", "product_sk product_id product_name list_price"),
    *_nulls("dim_date", "dim_date", "date_sk date_actual year"),
    *_nulls("fact_sales", "fact", "order_line_sk customer_sk product_sk order_date_sk order_id "
            "quantity unit_price net_revenue channel profit_margin_pct"),
    *_uniques(("dim_customer", "dim_customer", "customer_sk"),
              ("dim_customer", "dim_customer", "customer_id"),
              ("dim_product", "dim_product", "product_sk"),
              ("dim_product", "dim_product", "product_id"),
              ("dim_date", "dim_date", "date_sk"),
              ("dim_date", "dim_date", "date_actual"),
              ("fact_sales", "fact", "order_line_sk")),
    *_parents("fact_sales", "fact", ("customer_sk", "dim_customer", "customer_sk"),
              ("product_sk", "dim_product", "product_sk"),
              ("order_date_sk", "dim_date", "date_sk")),
    ("dim_customer.income_bracket.accepted", "error",
     "select count(*) from dim_customer where income_bracket not in "
     "('LOW', 'MEDIUM', 'HIGH', 'VERY_HIGH')"),
    ("fact_sales.quantity.accepted", "error",
     "select count(*) from fact where quantity not between 1 and 50"),
    ("fact_sales.channel.accepted", "error",
     "select count(*) from fact where channel not similar to '[1-5]-.*|POS_Retail|Online_Realtime'"),
    ("fact_sales.is_bad_data_record.accepted", "error",
     "select count(*) from fact where is_bad_data_record not in (0, 1)"),
    ("fact_sales.margin_range", "warn",
     "select count(*) from fact where abs(profit_margin_pct) > 100"),
    ("fact_sales.customer_orphans", "warn", "select count(*) from fact where customer_sk is null"),
    ("fact_sales.dimensions_complete", "warn",
     "select max((customer_sk is null)::int) + max((product_sk is null)::int) from fact"),
    ("fact_sales.daily_gaps", "warn",
     "select count(*) from spine where date_actual not in (select order_date from fact) and "
     "date_actual between (select min(order_date) from fact) and (select max(order_date) from fact)"),
    ("snap_customers.starts_in_order", "warn",
     "select count(*) from (select *, lag(valid_from) over (partition by customer_id order by valid_from) as p "
     "from history) where valid_from < p"),
    ("snap_customers.no_overlap", "warn",
     "select count(*) - count(distinct customer_id) from history"),
    ("sources.freshness", "warn",
     "select (select (max(signup_date) < date '2024-01-25' - 30)::int from raw_customers) + "
     "(select (max(launch_date) < date '2024-01-25' - 30)::int from raw_products) + "
     "(select (max(order_date) < date '2024-01-25' - 30)::int from dirty_sales)"),
))

# --- history -----------------------------------------------------------------------------

_VERSION = "md5({key} || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S')) as version_id"
_STAMP = ("strftime({c}, '%Y-%m-%d %H:%M:%S.000000') as {c}")
_META = ", ".join((
    _STAMP.format(c="valid_from"), _STAMP.format(c="valid_to"), _VERSION,
    "strftime(history.valid_from, '%Y-%m-%d %H:%M:%S.000000') as updated_at",
))

SQL["customer_metrics_merged"] = SQL["customer_metrics"]
SQL["product_metrics_merged"] = SQL["product_metrics"]
SQL["snapshot"] = SQL["scd2_merge"] = CLEAN(
    _CUSTOMER_HISTORY
    + f"select customer_id, city, gender, income_bracket, {_META.format(key='customer_id')} from history"
)
SQL["current_rows"] = CLEAN(
    _CUSTOMER_HISTORY
    + f"select customer_id, city, {_STAMP.format(c='valid_from')} from history where valid_to is null"
)
SQL["scd2_overlaps"] = CLEAN(_CUSTOMER_HISTORY + f"""
, follow as (
  select customer_id, valid_from, lag(valid_from) over w as prev_valid_from from history
  window w as (partition by customer_id order by valid_from)
)
select customer_id, {_STAMP.format(c='valid_from')}, null::varchar as valid_to,
  {_STAMP.format(c='prev_valid_from')}, null::varchar as prev_valid_to
from follow where prev_valid_from is not null""")
SQL["scd2_products"] = CLEAN(f"""
, history as (
  select product_id, brand, list_price, timestamp '2024-01-01' as valid_from,
    if(category = 'PROMO' or weight_kg > 40, timestamp '2024-01-02', null) as valid_to
  from products
  union all
  select product_id, 'Brand', list_price + 1, timestamp '2024-01-02', null from products
  where category <> 'PROMO' and weight_kg > 40
)
select product_id, brand, list_price::double as list_price, {_META.format(key='product_id')}
from history""")

# --- assignment ----------------------------------------------------------------------------

_COHORT = """case when p < 150000 then 'LOYAL_HEAVY' when p < 350000 then 'LOYAL_LIGHT'
  when p < 550000 then 'GROWING' when p < 700000 then 'DECLINING' when p < 850000 then 'ONE_SHOT'
  else 'CHURN_RISK' end"""
_PLACED = """
with placed as (
  select c_custkey, c_custkey % 1000003 * 7919 % 1000000 as p,
    (c_custkey % 1000003 * 7919 + 500009) % 1000000 as q
  from customer
)"""
SQL["assign_weighted"] = f"{_PLACED} select c_custkey, {_COHORT} as cohort from placed"
SQL["assign_weighted_by"] = f"""{_PLACED},
limits(cohort, low, medium, high) as (values
  ('LOYAL_HEAVY', 10, 40, 80), ('LOYAL_LIGHT', 15, 55, 85), ('GROWING', 20, 60, 90),
  ('DECLINING', 35, 75, 95), ('ONE_SHOT', 40, 75, 95), ('CHURN_RISK', 50, 80, 95))
select c_custkey, cohort,
  case when q < low * 10000 then 'LOW' when q < medium * 10000 then 'MEDIUM'
       when q < high * 10000 then 'HIGH' else 'VERY_HIGH' end as income_bracket
from (select *, {_COHORT} as cohort from placed) join limits using (cohort)"""
SQL["assign_hashed"] = f"""
with placed as (
  select ('0x' || left(md5('cohort|' || c_custkey), 8))::bigint % 1000000 as p from customer
)
select {_COHORT} as cohort, count(*) as customers from placed group by 1"""
