"""Shared CTEs: the bronze shapes and the layers above them."""

from __future__ import annotations

BRONZE = """
raw_customers as (
  select c_custkey::varchar as customer_id, split_part(c_name, '#', 1) as first_name,
    split_part(c_name, '#', 2) || ' ' as last_name, ' ' || c_name || '@Example.com' as email,
    '555-' || c_custkey as phone, c_custkey || ' Main Street' as address_line1,
    '' as address_line2, n_name as city, lower(r_name) as state,
    c_nationkey::varchar as postal_code, ' ' || lower(n_name) as country,
    date '1950-01-01' + (c_custkey % 19000)::int as birth_date,
    if(c_custkey % 2 = 0, 'f', 'm') as gender,
    case when c_acctbal < 0 then 'low' when c_acctbal < 4000 then 'medium'
         when c_acctbal < 8000 then 'high' else 'very_high' end as income_bracket,
    c_mktsegment as cohort, date '1995-01-01' + (c_custkey % 2000)::int as signup_date,
    date '1995-01-01' + (c_custkey % 2000)::int as last_update_date
  from customer left join nation on n_nationkey = c_nationkey
    left join region on r_regionkey = n_regionkey
),
raw_products as (
  select p_partkey::varchar as product_id, ' ' || p_name as product_name, p_type as category,
    p_name as subcategory, p_brand || ' ' as brand, p_retailprice::decimal(10,2) as list_price,
    (p_retailprice::decimal(10,2) * 0.60::decimal(3,2))::decimal(10,2) as standard_cost,
    split_part(p_name, ' ', 1) as color, p_size::varchar as size,
    p_size::decimal(8,2) as weight_kg,
    date '1995-01-01' + (p_partkey % 1000)::int as launch_date,
    if(p_partkey % 10 = 0, date '1995-01-01' + (p_partkey % 1000 + 1000)::int, null)
      as discontinued_date
  from part
),
raw_sales as (
  select l_orderkey::varchar as order_id, l_linenumber::int as line_item_id,
    o_orderdate::date as order_date, o_custkey::varchar as customer_id,
    l_partkey::varchar as product_id, l_quantity::int as quantity,
    l_extendedprice::decimal(10,2) as unit_price,
    (l_extendedprice::decimal(10,2) * l_discount::decimal(3,2))::decimal(10,2)
      as discount_amount,
    l_shipdate::date as ship_date, 'City ' || l_suppkey as ship_city,
    lower(o_orderstatus) as ship_state, lower(l_linestatus) as ship_country,
    o_orderpriority || ' ' as channel
  from lineitem left join orders on o_orderkey = l_orderkey
),
dirty_sales as (
  select * replace (
    case order_id::bigint % 97 when 1 then null when 2 then '  ' else customer_id end
      as customer_id,
    if(order_id::bigint % 97 = 3, -quantity, quantity) as quantity,
    if(order_id::bigint % 97 = 4, date '2099-01-01', order_date) as order_date,
    if(order_id::bigint % 97 = 5, 0, unit_price)::decimal(10,2) as unit_price,
    if({unknown} and order_id::bigint % 97 = 6, 'X' || product_id, product_id) as product_id)
  from raw_sales
),
raw_stream as (
  select 'evt_' || event_id as event_id,
    'STREAM-STORE-' || (user_id % 5 + 101) || '-' || strftime(ts, '%Y%m%d') || '-' || event_id
      as order_id,
    1::bigint as line_item_id, ts::date as order_date,
    'STORE-' || (user_id % 5 + 101) as store_id, 'Store ' || (user_id % 5 + 101) as store_name,
    'POS-' || (user_id % 5 + 101) || '-A' as pos_terminal_id, user_id::varchar as customer_id,
    props::json ->> '$.k' as product_id, event_id % 5 + 1 as quantity, value as unit_price,
    if(event_id % 4 = 0, (event_id % 5 + 1) * 0.25, 0)::double as discount_amount,
    ts::date as ship_date, 'City ' || (user_id % 5 + 101) as ship_city, 'ny' as ship_state,
    'usa' as ship_country, if(user_id % 5 = 4, 'Online_Realtime', 'POS_Retail') as channel,
    if(event_id % 2 = 0, 'Card', 'Cash') as payment_method, ts as created_at
  from events where event_type = 'purchase'
)"""

SILVER = """
customers as (
  select md5(customer_id) as customer_sk, customer_id, trim(first_name) as first_name,
    trim(last_name) as last_name, lower(trim(email)) as email, phone, address_line1,
    address_line2, trim(city) as city, upper(state) as state, postal_code,
    upper(trim(country)) as country, birth_date, upper(gender) as gender,
    upper(income_bracket) as income_bracket, upper(cohort) as cohort, signup_date,
    last_update_date
  from raw_customers
),
products as (
  select * replace (trim(product_name) as product_name, trim(brand) as brand),
    md5(product_id) as product_sk
  from raw_products
),
lines as (
  select trim(order_id) as order_id, line_item_id::int as line_item_id,
    md5(order_id || '|' || line_item_id) as order_line_sk, trim(customer_id) as customer_id,
    product_id, order_date, ship_date, quantity::int as quantity,
    unit_price::decimal(10,2) as unit_price, discount_amount::decimal(10,2) as discount_amount,
    ship_city, upper(ship_state) as ship_state, upper(ship_country) as ship_country,
    trim(channel) as channel, store_id, store_name, pos_terminal_id, payment_method, is_streaming
  from (select *, 0 as is_streaming from {batch}
        union all by name
        select * exclude (event_id, created_at), 1 as is_streaming from raw_stream
        where {stream})
),
flagged as (
  select *, greatest(is_null_customer, is_null_order_key, is_negative_quantity, is_future_date,
                     is_zero_price) as is_bad_data_record
  from (select *, (coalesce(customer_id, '') = '')::int as is_null_customer,
          (coalesce(order_id, '') = '' or line_item_id is null)::int as is_null_order_key,
          coalesce(quantity < 0, false)::int as is_negative_quantity,
          coalesce(order_date > date '{as_of}', false)::int as is_future_date,
          coalesce(unit_price <= 0, false)::int as is_zero_price
        from lines)
),
sales as (
  select distinct on (order_id, line_item_id) * from flagged where is_bad_data_record = 0
  order by order_id, line_item_id, order_date desc, is_streaming, product_id, ship_date,
    quantity, unit_price, discount_amount, customer_id, channel, ship_city, ship_state,
    ship_country
),
details as (
  select *, gross_revenue - total_cost as gross_profit, net_revenue - total_cost as net_profit,
    if(gross_revenue > 0,
       (net_revenue - total_cost)::double / gross_revenue::double * 100, null)
      as profit_margin_pct
  from (
    select s.*, customer_sk, product_sk, list_price, standard_cost,
      quantity * unit_price as gross_revenue,
      quantity * (unit_price - discount_amount) as net_revenue,
      quantity * standard_cost as total_cost
    from sales s left join products using (product_id) left join customers using (customer_id))
),
customer_totals as (
  select customer_id, customer_sk, count(distinct order_id) as total_orders,
    count(*) as total_line_items, sum(quantity)::bigint as total_units_purchased,
    sum(net_revenue) as total_revenue, sum(gross_revenue) as total_gross_revenue,
    sum(total_cost) as total_cost, sum(net_profit) as total_profit,
    sum(profit_margin_pct::decimal(30,12))::double / count(profit_margin_pct) as avg_profit_margin_pct, sum(net_revenue)::double / count(net_revenue) as avg_order_value,
    min(order_date) as first_order_date, max(order_date) as last_order_date,
    count(distinct product_id) as distinct_products_purchased,
    count(distinct (year(order_date), month(order_date))) as active_months
  from details group by all
),
customer_metrics as (
  select *, (date '{as_of}' - last_order_date)::int as days_since_last_order,
    case when total_revenue >= 45e6 then 'HIGH_VALUE' when total_revenue >= 30e6 then 'MID_VALUE'
         else 'LOW_VALUE' end as value_segment,
    case when total_orders >= 20 then 'FREQUENT_BUYER' when total_orders >= 5
         then 'REGULAR_BUYER' when total_orders >= 1 then 'OCCASIONAL_BUYER'
         else 'NEW_BUYER' end as frequency_segment,
    case when last_order_date is null then 'NEW'
         else ['ACTIVE', 'RECENT', 'LAPSED', 'CHURNED']
           [1 + (days_since_last_order > 30)::int + (days_since_last_order > 90)::int
              + (days_since_last_order > 180)::int] end as recency_segment,
    case when total_revenue >= 45e6 and total_orders >= 20 then 'PLATINUM'
         when total_revenue >= 30e6 and total_orders >= 10 then 'GOLD'
         when total_revenue >= 10e6 then 'SILVER' else 'BRONZE' end as customer_tier
  from customer_totals
),
product_totals as (
  select product_id, product_sk, count(distinct order_id) as total_orders,
    count(*) as total_line_items, sum(quantity)::bigint as total_units_sold,
    sum(net_revenue) as total_revenue, sum(gross_revenue) as total_gross_revenue,
    sum(total_cost) as total_cost, sum(net_profit) as total_profit,
    sum(profit_margin_pct::decimal(30,12))::double / count(profit_margin_pct) as avg_profit_margin_pct, sum(net_revenue)::double / count(net_revenue)
      as avg_revenue_per_order,
    count(distinct customer_id) as unique_customers, min(order_date) as first_sale_date,
    max(order_date) as last_sale_date
  from details group by all
),
product_metrics as (
  select *, {rank_of_revenue} as revenue_rank, {rank_of_volume} as volume_rank,
    {rank_of_profit} as profit_rank, {rank_of_margin} as margin_rank
  from product_totals
)"""

GOLD = """
spine as (
  select unnest(range(date '1995-01-01', date '2025-01-01', interval 1 day))::date as date_actual
),
dim_date as (
  select strftime(date_actual, '%Y%m%d')::int as date_sk, date_actual,
    year(date_actual)::int as year, quarter(date_actual)::int as quarter,
    'Q' || quarter(date_actual) as quarter_label, month(date_actual)::int as month,
    monthname(date_actual) as month_name, left(monthname(date_actual), 3) as month_name_short,
    month(date_actual)::int as month_of_year, weekofyear(date_actual)::int as week_of_year,
    day(date_actual)::int as day_of_month, dayofweek(date_actual)::int as day_of_week,
    dayname(date_actual) as day_name, left(dayname(date_actual), 3) as day_name_short,
    (dayofweek(date_actual) % 6 = 0)::int as is_weekend, year(date_actual)::int as fiscal_year,
    quarter(date_actual)::int as fiscal_quarter,
    make_date(year(date_actual), month(date_actual), 1) as month_start_date,
    make_date(year(date_actual), 1, 1) as year_start_date,
    make_date(year(date_actual), month(date_actual), 1) as first_day_of_month,
    last_day(date_actual) as last_day_of_month,
    ['Winter', 'Spring', 'Summer', 'Fall'][month(date_actual) % 12 // 3 + 1] as season,
    case strftime(date_actual, '%m%d') when '0101' then 'New Year' when '0214' then 'Valentine'
      when '1225' then 'Christmas' when '1231' then 'New Year Eve' end as holiday_name,
    (strftime(date_actual, '%m%d') in ('0101', '0214', '1225', '1231'))::int as is_holiday
  from spine
),
dim_customer as (
  select c.*, year(date '{as_of}')::int - year(birth_date)::int as age,
    m.* exclude (customer_id, customer_sk)
  from customers c left join customer_metrics m on m.customer_id = c.customer_id
),
dim_product as (
  select p.*, category as product_category, subcategory as product_subcategory,
    brand as product_brand, list_price - standard_cost as markup_amount,
    if(list_price > 0, (list_price - standard_cost)::double / list_price::double * 100, null)
      as markup_pct,
    if(discontinued_date is null, 'ACTIVE', 'DISCONTINUED') as product_status,
    m.* exclude (product_id, product_sk)
  from products p left join product_metrics m on m.product_id = p.product_id
),
fact as (
  select d.* exclude (customer_sk, product_sk), c.customer_sk, p.product_sk,
    o.date_sk as order_date_sk, s.date_sk as ship_date_sk
  from details d left join dim_customer c on c.customer_id = d.customer_id
    left join dim_product p on p.product_id = d.product_id
    left join dim_date o on o.date_actual = d.order_date
    left join dim_date s on s.date_actual = d.ship_date
),
obt as (
  select f.order_line_sk, f.order_id, f.line_item_id, f.order_date, f.ship_date, f.quantity,
    f.unit_price, f.discount_amount, f.list_price, f.standard_cost, f.gross_revenue,
    f.net_revenue, f.total_cost, f.gross_profit, f.net_profit, f.profit_margin_pct, f.channel,
    f.store_id, f.store_name, f.pos_terminal_id, f.payment_method, f.is_streaming,
    c.customer_id, c.first_name, c.last_name, c.email, c.city as customer_city,
    c.state as customer_state, c.postal_code as customer_postal_code,
    c.country as customer_country, c.gender, c.income_bracket, c.cohort, c.age, c.signup_date,
    c.value_segment, c.frequency_segment, c.recency_segment, c.customer_tier,
    c.total_orders as customer_total_orders, c.total_revenue as customer_total_revenue,
    p.product_id, p.product_name, p.category, p.subcategory, p.brand, p.product_category,
    p.product_subcategory, p.product_brand, p.color, p.size,
    p.list_price as product_list_price, p.standard_cost as product_standard_cost,
    p.product_status, p.revenue_rank, p.volume_rank,
    o.year as order_year, o.quarter as order_quarter, o.quarter_label as order_quarter_label,
    o.month as order_month, o.month_name as order_month_name,
    o.week_of_year as order_week_of_year, o.day_of_month as order_day_of_month,
    o.day_of_week as order_day_of_week, o.day_name as order_day_name,
    o.is_weekend as order_is_weekend, o.season as order_season,
    o.is_holiday as order_is_holiday, o.holiday_name as order_holiday_name,
    s.year as ship_year, s.month as ship_month, s.month_name as ship_month_name,
    s.day_of_week as ship_day_of_week, s.day_name as ship_day_name
  from fact f left join dim_customer c on c.customer_sk = f.customer_sk
    left join dim_product p on p.product_sk = f.product_sk
    left join dim_date o on o.date_sk = f.order_date_sk
    left join dim_date s on s.date_sk = f.ship_date_sk
)"""


def _rank(measure: str) -> str:
    return f"row_number() over (order by {measure} desc nulls last, product_id)"


def with_layers(
    body: str, *, as_of: str, stream: bool = True, batch: str = "dirty_sales", unknown: bool = True
) -> str:
    """``body`` behind all layers; DuckDB drops the ones it does not use."""
    values = {
        "as_of": as_of,
        "stream": str(stream).lower(),
        "batch": batch,
        "unknown": str(unknown).lower(),
        "rank_of_revenue": _rank("total_revenue"),
        "rank_of_volume": _rank("total_units_sold"),
        "rank_of_profit": _rank("total_profit"),
        "rank_of_margin": _rank("avg_profit_margin_pct"),
    }
    layers = ",".join((BRONZE, SILVER, GOLD))
    for name, value in values.items():
        layers = layers.replace("{" + name + "}", value)
    return f"with {layers}\n{body}"
