"""The registered queries as ANSI SQL for DuckDB, written independently of the Spark code.

Money is added up in whole cents. ``half_up`` rounds a quotient of integers half up without going
through a binary fraction.
"""

from __future__ import annotations

from ledgerloom import schemas
from ledgerloom.testbed.bronze_views import SPREAD_DAYS, SPREAD_KEYS, raw_sql
from ledgerloom.testbed.queries import DAY, MARKETS, MOVED, NATIONS

TODAY = f"DATE '{DAY}'"


def cents(value: str) -> str:
    return f"cast(cast({value} as decimal(18,2)) * 100 as hugeint)"


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """round(numerator / denominator, digits) of integers, denominator > 0, as double."""
    top = f"cast({numerator} as hugeint)"
    bottom = f"nullif(cast({denominator} as hugeint), 0)"
    scale = 10 ** digits
    size = f"((2 * abs({top}) * {scale} + {bottom}) // (2 * {bottom}))"
    return f"(cast(sign({top}) * {size} as double) / {scale})"


def dollars(value: str) -> str:
    return f"(cast({value} as double) / 100)"


def capital(text: str) -> str:
    return f"upper(left(trim({text}), 1)) || lower(substr(trim({text}), 2))"


def words(values: list[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


RAW = {f"raw_{name}": raw_sql(name) for name in schemas.ENTITIES}

TYPED = {
    "typed_orders": """
select order_id, customer_id, lower(trim(status)) as status, try_cast(subtotal as double) as subtotal,
  try_cast(shipping as double) as shipping, try_cast(total as double) as total,
  upper(trim(currency)) as currency, try_cast(created_at as timestamp) as created_at,
  try_cast(updated_at as timestamp) as updated_at, lower(trim(channel)) as channel, promo_code,
  cast(try_cast(created_at as timestamp) as date) as order_date,
  cast(extract(hour from try_cast(created_at as timestamp)) as integer) as order_hour,
  promo_code is not null as is_promoted
from raw_orders""",
    "typed_customers": f"""
select customer_id, name, lower(trim(email)) as email, upper(trim(country)) as country,
  try_cast(signup_date as date) as signup_date, {capital('segment')} as segment, phone, city
from raw_customers""",
    "typed_products": f"""
select product_id, name, {capital('category')} as category, try_cast(price as double) as price,
  try_cast(cost as double) as cost, try_cast(stock_qty as integer) as stock_qty, supplier,
  upper(trim(sku)) as sku, try_cast(rating as double) as rating,
  try_cast(review_count as integer) as review_count,
  case when try_cast(price as double) > 0 then
    {half_up(f"({cents('price')} - {cents('cost')}) * 100", cents('price'), 2)} end as margin_pct,
  try_cast(stock_qty as integer) < 10 as is_low_stock
from raw_products""",
    "typed_order_items": f"""
select item_id, order_id, product_id, try_cast(quantity as integer) as quantity,
  try_cast(unit_price as double) as unit_price, try_cast(discount as double) as discount,
  try_cast(line_total as double) as line_total, try_cast(created_at as timestamp) as created_at,
  {half_up(f"try_cast(quantity as integer) * {cents('unit_price')} * (100 - {cents('discount')})", "10000", 2)}
    as line_total_recalc,
  abs({cents('line_total')} - cast(round(100 * {half_up(
      f"try_cast(quantity as integer) * {cents('unit_price')} * (100 - {cents('discount')})", "10000", 2)}) as hugeint))
    > 1 as total_mismatch
from raw_order_items""",
}

REJECT = {
    "orders": """case when order_id is null then 'missing order_id'
  when customer_id is null then 'missing customer_id' when total is null then 'total is no amount'
  when total < 0 then 'negative total' end""",
    "customers": r"""case when customer_id is null then 'missing customer_id'
  when email is null or not regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$') then 'invalid email' end""",
    "products": """case when product_id is null then 'missing product_id'
  when price is null or not price > 0 then 'price not positive' end""",
    "order_items": """case when item_id is null then 'missing item_id'
  when order_id is null then 'missing order_id'
  when quantity is null or not quantity > 0 then 'quantity not positive' end""",
}



def newest_first(name: str) -> str:
    """The order in which rows of one key compete: the rule of the table, then all its columns."""
    first = ["updated_at"] if name == "orders" else []
    columns = [*first, *schemas.ENTITY_TYPES[name]]
    return ", ".join(f"{column} desc nulls last" for column in columns)


SILVER = {
    f"silver_{name}": f"""
select * exclude (nth) from (
  select *, row_number() over (partition by {schemas.KEYS[name]}
    order by {newest_first(name)}) as nth
  from typed_{name} where ({REJECT[name]}) is null)
where nth = 1"""
    for name in schemas.ENTITIES
}

GOLD = {
    "gold_daily": f"""
select order_date, channel, total_orders, {dollars('gross')} as gross_revenue,
  {dollars('promo')} as promo_revenue, {half_up('gross', '100 * amounts', 2)} as avg_item_value,
  total_items_sold, total_units, {half_up('gross', '100 * total_orders', 2)} as aov,
  {half_up('promo * 100', 'gross', 1)} as promo_pct, '{DAY}' as date_partition
from (
  select o.order_date, o.channel, count(distinct o.order_id) as total_orders,
    sum({cents('i.line_total')}) as gross,
    sum(case when o.is_promoted then {cents('i.line_total')} end) as promo,
    count(i.line_total) as amounts, count(distinct i.item_id) as total_items_sold,
    cast(sum(i.quantity) as bigint) as total_units
  from silver_order_items i join silver_orders o on i.order_id = o.order_id
  where o.status <> 'cancelled' group by o.order_date, o.channel)""",
    "rfm_raw": f"""
select customer_id, max(order_date) as last_order_date, count(distinct order_id) as frequency,
  {dollars(f"sum({cents('total')})")} as monetary,
  cast({TODAY} - max(order_date) as integer) as recency_days
from silver_orders where status <> 'cancelled' group by customer_id""",
    "rfm_bounds": """
select quantile_disc(recency_days, [0.25, 0.5, 0.75]) as r, quantile_disc(frequency, [0.25, 0.5, 0.75]) as f,
  quantile_disc(monetary, [0.25, 0.5, 0.75]) as m from rfm_raw""",
    "rfm_scored": """
select w.*,
  cast(case when recency_days <= r[1] then 4 when recency_days <= r[2] then 3
    when recency_days <= r[3] then 2 else 1 end as integer) as r_score,
  cast(case when frequency >= f[3] then 4 when frequency >= f[2] then 3
    when frequency >= f[1] then 2 else 1 end as integer) as f_score,
  cast(case when monetary >= m[3] then 4 when monetary >= m[2] then 3
    when monetary >= m[1] then 2 else 1 end as integer) as m_score
from rfm_raw w cross join rfm_bounds""",
    "gold_rfm": f"""
select s.customer_id, last_order_date, frequency, monetary, recency_days, r_score, f_score, m_score,
  cast(r_score + f_score + m_score as integer) as rfm_score,
  case when r_score + f_score + m_score >= 10 then 'Champions'
    when r_score + f_score + m_score >= 8 then 'Loyal Customers'
    when r_score + f_score + m_score >= 6 then 'Potential Loyalists'
    when r_score + f_score + m_score >= 4 then 'At Risk' else 'Lost' end as rfm_segment,
  c.country, c.segment, c.signup_date, '{DAY}' as date_partition
from rfm_scored s left join silver_customers c on s.customer_id = c.customer_id""",
    "product_sums": f"""
select i.product_id, cast(sum(i.quantity) as bigint) as units_sold,
  {dollars(f"sum({cents('i.line_total')})")} as revenue, count(distinct i.order_id) as order_count,
  {half_up(f"sum({cents('i.discount')})", "100 * count(i.discount)", 4)} as avg_discount,
  max(o.order_date) as last_sold_date
from silver_order_items i join silver_orders o on i.order_id = o.order_id
where o.status <> 'cancelled' group by i.product_id""",
    "gold_products": f"""
select s.product_id, units_sold, revenue, order_count, avg_discount, last_sold_date, p.name, p.category,
  p.price, p.cost, p.margin_pct, p.rating, p.review_count, p.is_low_stock,
  cast(rank() over (order by revenue desc nulls last) as integer) as rank_by_revenue,
  cast(rank() over (order by units_sold desc nulls last) as integer) as rank_by_units,
  '{DAY}' as date_partition
from product_sums s left join silver_products p on s.product_id = p.product_id""",
    "gold_geo": f"""
select c.country, o.order_date, {dollars(f"sum({cents('o.total')})")} as revenue,
  count(distinct o.order_id) as orders, count(distinct o.customer_id) as unique_customers,
  {half_up(f"sum({cents('o.total')})", "100 * count(o.total)", 2)} as aov, '{DAY}' as date_partition
from silver_orders o left join silver_customers c on o.customer_id = c.customer_id
where o.status <> 'cancelled' group by c.country, o.order_date""",
    "gold_funnel": f"""
select order_date, status, count(order_id) as order_count,
  {dollars(f"sum({cents('total')})")} as total_value, '{DAY}' as date_partition
from silver_orders group by order_date, status""",
}


def _flat_columns(table: str) -> str:
    changed = {
        "orders": {"status": "lower(trim(coalesce(status, '')))", "currency": "upper(trim(coalesce(currency, '')))",
                   "channel": "lower(trim(coalesce(channel, '')))",
                   "total": "coalesce(abs(try_cast(total as double)), 0)"},
        "customers": {"email": "lower(trim(coalesce(email, '')))", "country": "upper(trim(coalesce(country, '')))"},
        "products": {"category": capital("coalesce(category, '')"), "sku": "upper(trim(coalesce(sku, '')))"},
        "order_items": {},
    }[table]
    return ", ".join(f"{changed.get(name, f'''coalesce({name}, '')''')} as {name}"
                     for name in schemas.ENTITY_TYPES[table])


FLAT = {
    **{f"flat_{name}": f"""
select * exclude (nth) from (
  select *, row_number() over (partition by {schemas.KEYS[name]}
    order by {', '.join((['updated_at'] if name == 'orders' else []) + list(schemas.ENTITY_TYPES[name]))}) as nth
  from (select {_flat_columns(name)} from raw_{name}) where {schemas.KEYS[name]} <> '')
where nth = 1""" for name in schemas.ENTITIES},
    "flat_daily": f"""
select order_date, channel, total_orders, {dollars('gross')} as gross_revenue, cast(0 as bigint) as total_units,
  {half_up('gross', '100 * total_orders', 2)} as aov
from (select substr(created_at, 1, 10) as order_date, channel, count(*) as total_orders,
    sum({cents('total')}) as gross
  from flat_orders where status <> 'cancelled' group by 1, 2)""",
    "flat_geo": f"""
select coalesce(c.country, 'Unknown') as country, count(*) as orders,
  {dollars(f"sum({cents('o.total')})")} as revenue
from flat_orders o left join flat_customers c on o.customer_id = c.customer_id
where o.status <> 'cancelled' group by 1""",
    "flat_funnel": "select status, count(*) as order_count from flat_orders group by status",
}


def _day_of(key: str) -> str:
    return f"strftime({TODAY} - cast(cast({key} as bigint) % {SPREAD_DAYS} as integer), '%Y-%m-%d')"


BY_DAY = {
    f"by_day_{name}": f"""
select * exclude (nth) from (
  select *, row_number() over (partition by date_partition, {schemas.KEYS[name]}
    order by {newest_first(name)}) as nth
  from (select *, {_day_of(SPREAD_KEYS[name])} as date_partition from typed_{name} where ({REJECT[name]}) is null))
where nth = 1"""
    for name in schemas.ENTITIES
}

COUNTS = {
    "table_counts": "union all".join(f"""
select '{layer}' as layer, '{title}' as table_name, (select count(*) from {view}) as row_count """
        for layer, title, view in [
            *[("silver", name, f"silver_{name}") for name in schemas.ENTITIES],
            *[("rejected", name, f"(select * from typed_{name} where ({REJECT[name]}) is not null)")
              for name in schemas.ENTITIES],
            ("gold", "daily_revenue_summary", "gold_daily"), ("gold", "customer_rfm", "gold_rfm"),
            ("gold", "product_performance", "gold_products"), ("gold", "geo_revenue", "gold_geo"),
            ("gold", "order_status_funnel", "gold_funnel")]),
    "flat_counts": "union all".join(f"""
select '{layer}' as layer, '{title}' as table_name, (select count(*) from {view}) as row_count """
        for layer, title, view in [
            *[("flat_silver", name, f"flat_{name}") for name in schemas.ENTITIES],
            ("flat_gold", "daily_revenue", "flat_daily"), ("flat_gold", "geo_revenue", "flat_geo"),
            ("flat_gold", "order_funnel", "flat_funnel"), ("flat_gold", "orders_processed", "flat_orders")]),
}

# Named steps in an order in which each uses only earlier ones.
STEPS = {**RAW, **TYPED, **SILVER, **GOLD, **FLAT, **BY_DAY, **COUNTS}


def _query(body: str) -> str:
    """The body with the steps it needs, directly or through other steps, as CTEs."""
    text, needed = body, set()
    for name in reversed(STEPS):
        if name in text:
            needed.add(name)
            text += STEPS[name]
    steps = ",\n".join(f"{name} as ({STEPS[name]})" for name in STEPS if name in needed)
    return f"with {steps}\n{body}" if steps else body


def _silver(name: str) -> str:
    columns = ", ".join([*schemas.ENTITY_TYPES[name], *schemas.DERIVED_TYPES[name]])
    return f"select {columns}, '{DAY}' as job_date, '{DAY}' as date_partition from silver_{name}"


def _row_check(table: str, name: str, failed: str) -> str:
    return (f"select '{name}' as check_name, count(*) filter (where {failed}) as failed, "
            f"count(*) as total from typed_{table}")


def _unique_check(table: str, name: str, column: str) -> str:
    return (f"select '{name}' as check_name, count(*) filter (where n > 1) as failed, count(*) as total "
            f"from (select count(*) as n from typed_{table} where {column} is not null group by {column})")


LINE_GAP = (f"abs({cents('line_total')} - cast(round(line_total_recalc * 100) as hugeint)) >= 2")

DQ_SUMMARY = "\nunion all ".join([
    _row_check("orders", "orders_status_known",
               f"status is null or status not in ({words(schemas.STATUSES)})"),
    _row_check("orders", "orders_channel_known",
               f"channel is null or channel not in ({words(schemas.CHANNELS)})"),
    _row_check("orders", "orders_total_not_negative", "total < 0"),
    _row_check("orders", "orders_total_covers_subtotal", f"{cents('total')} < {cents('subtotal')} - 1"),
    _row_check("customers", "customers_segment_known", f"segment is null or segment not in ({words(MARKETS)})"),
    _row_check("customers", "customers_country_known", f"country is null or country not in ({words(NATIONS)})"),
    _row_check("products", "products_price_positive", "price <= 0"),
    _row_check("products", "products_cost_positive", "cost <= 0"),
    _row_check("products", "products_cost_below_price", "cost >= price"),
    _row_check("products", "products_stock_not_negative", "stock_qty < 0"),
    _row_check("order_items", "items_line_total_matches", LINE_GAP),
    _unique_check("orders", "orders_key_unique", "order_id"),
    _unique_check("customers", "customers_key_unique", "customer_id"),
    _unique_check("customers", "customers_email_unique", "email"),
    _unique_check("products", "products_key_unique", "product_id"),
    _unique_check("order_items", "items_key_unique", "item_id"),
    "select 'items_order_exists' as check_name, count(*) filter (where order_id is null or not exists "
    "(select 1 from typed_orders o where o.order_id = i.order_id)) as failed, count(*) as total "
    "from typed_order_items i",
])


def _recent(days: int) -> str:
    return f"order_date >= {TODAY} - {days}"


# Table and status of the files that the events name, told from the order's key.
FILE_EVENTS = """
select case o_orderkey % 7 when 0 then null when 1 then 'returns' when 3 then 'customers' when 4 then 'products' else 'orders' end as table_name,
  case o_orderkey % 7 when 0 then 'unrecognised key' when 1 then 'unknown table' when 2 then 'unsupported extension'
    else 'accepted' end as status,
  cast(o_orderkey % 4096 * 1024 + o_custkey as bigint) as size_bytes
from orders"""

BODIES = {
    **{f"silver_{name}": _silver(name) for name in schemas.ENTITIES},
    **{f"quarantine_{name}": f"select * from (select *, {REJECT[name]} as reject_reason from typed_{name}) "
                             "where reject_reason is not null" for name in schemas.ENTITIES},
    "gold_daily_revenue": "select * from gold_daily",
    "gold_customer_rfm": "select * from gold_rfm",
    "gold_product_performance": "select * from gold_products",
    "rfm_sketched_quartiles": """
select score, part, true as within from (values ('frequency'), ('monetary'), ('recency_days')) scores(score),
  (values (cast(0.25 as double)), (cast(0.5 as double)), (cast(0.75 as double))) parts(part)
where exists (select 1 from gold_rfm)""",
    "unique_customers": """
select c.country, count(distinct o.customer_id) as exact, true as within
from silver_orders o left join silver_customers c on o.customer_id = c.customer_id
where o.status <> 'cancelled' and o.customer_id is not null group by c.country""",
    "gold_geo_revenue": "select * from gold_geo",
    "gold_order_funnel": "select * from gold_funnel",
    **{f"flat_clean_{name}": f"select * from flat_{name}" for name in schemas.ENTITIES},
    "flat_daily_revenue": "select * from flat_daily",
    "flat_geo_revenue": "select * from flat_geo",
    "flat_order_funnel": "select * from flat_funnel",
    "revenue_overview": f"""
select order_date, {dollars(f"sum({cents('gross_revenue')})")} as total_revenue,
  cast(sum(total_orders) as bigint) as total_orders,
  {dollars(f"sum({cents('aov')})")} / count(aov) as avg_order_value,
  cast(sum(total_items_sold) as bigint) as items_sold,
  {half_up("sum(cast(cast(promo_pct as decimal(18,1)) * 10 as hugeint))", "10 * count(promo_pct)", 1)} as avg_promo_pct
from gold_daily where {_recent(30)} group by order_date order by order_date desc""",
    "revenue_by_channel": f"""
select channel, cast(sum(total_orders) as bigint) as orders,
  {dollars(f"sum({cents('gross_revenue')})")} as revenue,
  {half_up(f"sum({cents('aov')})", "100 * count(aov)", 2)} as aov
from gold_daily where {_recent(7)} group by channel order by revenue desc, channel""",
    "wow_growth": f"""
select week_start, {dollars('amount')} as revenue, {dollars('previous')} as prev_week_revenue,
  {half_up('(amount - previous) * 100', 'previous', 1)} as wow_growth_pct
from (select week_start, amount, lag(amount) over (order by week_start) as previous
  from (select cast(date_trunc('week', order_date) as date) as week_start, sum({cents('gross_revenue')}) as amount
    from gold_daily where {_recent(90)} group by 1))
order by week_start desc""",
    "top_products": f"""
select product_id, name, category, units_sold, revenue, order_count,
  {half_up(cents('margin_pct'), '100', 1)} as margin_pct, rating, rank_by_revenue
from gold_products where rank_by_revenue <= 10 order by rank_by_revenue, product_id""",
    "low_stock_alert": """
select product_id, name, category, units_sold, revenue, rank_by_revenue from gold_products
where is_low_stock order by revenue desc nulls last, product_id limit 20""",
    "segment_distribution": f"""
select rfm_segment, count(customer_id) as customer_count,
  {half_up(f"sum({cents('monetary')})", '100 * count(monetary)', 2)} as avg_lifetime_value,
  {half_up('sum(recency_days)', 'count(recency_days)', 0)} as avg_recency_days,
  {half_up('sum(frequency)', 'count(frequency)', 1)} as avg_orders,
  {dollars(f"sum({cents('monetary')})")} as total_revenue_contribution
from gold_rfm group by rfm_segment order by total_revenue_contribution desc, rfm_segment""",
    "top_countries": f"""
select country, {dollars(f"sum({cents('revenue')})")} as total_revenue,
  cast(sum(orders) as bigint) as total_orders, cast(sum(unique_customers) as bigint) as unique_customers,
  {half_up(f"sum({cents('aov')})", '100 * count(aov)', 2)} as avg_aov
from gold_geo where {_recent(30)} group by country order by total_revenue desc nulls last, country limit 15""",
    "funnel_share": f"""
select status, cast(sum(order_count) as bigint) as orders, {dollars(f"sum({cents('total_value')})")} as value,
  {half_up('sum(order_count) * 100', f"(select sum(order_count) from gold_funnel where {_recent(7)})", 1)}
    as pct_of_total
from gold_funnel where {_recent(7)} group by status order by orders desc, status""",
    "champions": """
select customer_id, rfm_segment, recency_days, frequency, monetary as lifetime_value, rfm_score, country,
  last_order_date
from gold_rfm where rfm_segment = 'Champions' order by monetary desc nulls last, customer_id limit 50""",
    "silver_quality": f"""
select date_partition, count(*) as row_count, count(distinct order_id) as unique_orders,
  count(*) filter (where total is null) as null_totals, min(total) as min_total, max(total) as max_total
from by_day_orders where date_partition >= strftime({TODAY} - 7, '%Y-%m-%d')
group by date_partition order by date_partition desc""",
    "latest_daily_revenue": "select * from gold_daily order by order_date desc, channel limit 30",
    "report_channels": f"""
select channel, cast(sum(total_orders) as bigint) as orders, {dollars(f"sum({cents('gross_revenue')})")} as revenue
from flat_daily group by channel order by revenue desc, channel""",
    "report_countries": "select * from flat_geo order by revenue desc, country",
    "report_funnel": f"""
select status, order_count,
  {half_up('order_count * 100', '(select sum(order_count) from flat_funnel)', 1)} as pct,
  repeat('#', cast(order_count * 50 // (select sum(order_count) from flat_funnel) as integer)) as bar
from flat_funnel order by order_count desc, status""",
    "report_summary": f"""
select cast(sum(total_orders) as bigint) as total_orders,
  {dollars(f"sum({cents('gross_revenue')})")} as total_revenue,
  {half_up(f"sum({cents('gross_revenue')})", '100 * sum(total_orders)', 2)} as avg_order_value,
  (select count(*) from flat_geo) as countries, count(distinct channel) as channels
from flat_daily""",
    "dq_summary": DQ_SUMMARY,
    "dq_orphan_items": """
select item_id, order_id, product_id from silver_order_items i
where not exists (select 1 from silver_orders o where o.order_id = i.order_id)""",
    "dq_duplicate_orders": """
select order_id, count(*) as occurrences from raw_orders where order_id is not null
group by order_id having count(*) > 1""",
    "dq_line_total": f"""
select item_id, quantity, unit_price, discount, line_total, line_total_recalc
from silver_order_items where {LINE_GAP}""",
    "global_rank": """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,
  rank() over (order by l_extendedprice desc nulls last) as rank_by_price,
  rank() over (order by l_quantity desc nulls last) as rank_by_quantity
from lineitem""",
    "bronze_round_trip": f"select *, {_day_of(SPREAD_KEYS['orders'])} as date_partition from raw_orders",
    "ingest_manifest": "\nunion all ".join(
        f"select distinct '{name}' as table_name, {_day_of(SPREAD_KEYS[name])} as ingest_date, '.csv' as ext, "
        f"'accepted' as status, cast(0 as bigint) as empty_files from raw_{name}" for name in schemas.ENTITIES),
    "ingest_summary": f"""
select table_name, status, count(*) as files, cast(sum(size_bytes) as bigint) as bytes from ({FILE_EVENTS}) group by 1, 2""",
    "ingest_totals": f"""
select count(*) as total_records, count(*) filter (where status = 'accepted') as processed_count,
  count(*) filter (where status <> 'accepted') as skipped_count from ({FILE_EVENTS})""",
    "backfill_range": "\nunion all ".join(
        f"select '{name}' as table_name, date_partition, count(*) as row_count from by_day_{name} "
        "group by date_partition" for name in schemas.ENTITIES),
    "ingest_new_files": f"""
select {', '.join(schemas.ENTITY_TYPES['orders'])}, order_date, order_hour, is_promoted,
  date_partition as job_date, date_partition from by_day_orders""",
    "mixed_headers_range": f"""
select {', '.join(name for name in schemas.ENTITY_TYPES['orders'] if name != 'promo_code')},
  case when cast(order_id as bigint) % 3 <> 2 then promo_code end as promo_code, order_date, order_hour,
  is_promoted and cast(order_id as bigint) % 3 <> 2 as is_promoted, date_partition as job_date, date_partition from by_day_orders""",
    "rejected_text": f"""
select * from (select 'orders' as table_name, order_id as key, {REJECT['orders']} as reject_reason, total as amount, amount_text
  from (select order_id, customer_id, total as amount_text, try_cast(total as double) as total from raw_orders))
where reject_reason is not null
union all
select * from (select 'products' as table_name, product_id as key, {REJECT['products']} as reject_reason, price as amount, amount_text
  from (select product_id, price as amount_text, try_cast(price as double) as price from raw_products))
where reject_reason is not null""",
    "gold_incremental": "select * exclude (date_partition) from (" + GOLD["gold_daily"].replace(
        "silver_orders o", f"(select * replace (case when {MOVED} then order_date + 3 else order_date end as order_date) "
                           "from silver_orders) o") + ")",
    "run_summary": "select * from table_counts",
    "run_flat_summary": "select * from flat_counts",
    "catalog_daily_revenue": "select * from gold_daily",
    "catalog_pruned": "\nunion all ".join(
        f"select '{name}' as table_name, count(*) as row_count, count(distinct {column}) as partitions_read from {view} where {asked}"
        for name, column, view, asked in [
            ("daily_revenue_summary", "order_date", "gold_daily", "order_date between date '1996-02-01' and date '1996-03-31'"),
            ("customer_rfm", "1", "gold_rfm", "true"),
            ("product_performance", "category", "gold_products", "category like 'P%'"),
            ("geo_revenue", "order_date", "gold_geo", "order_date between date '1999-12-15' and date '2000-01-14'"),
            ("order_status_funnel", "order_date", "gold_funnel", "order_date < date '1995-02-01'"),
            ("orders", "date_partition", "by_day_orders", "date_partition >= '2001-07-26'")]),
    "stream_silver_orders": _silver("orders"),
    "stream_merged_orders": _silver("orders"),
    "stream_batch_counts": "select count(*) as received, cast(0 as bigint) as failed, count(*) as sent from raw_orders",
    "stream_bronze_orders": "select * from raw_orders",
    "stream_json_counts": """
select count(*) as received, count(*) filter (where cast(order_id as bigint) % 89 = 0) as failed,
  count(*) filter (where cast(order_id as bigint) % 89 <> 0) as sent, sent as stored, failed as stored_lines from raw_orders""",
    "stream_json_orders": "select * from raw_orders where cast(order_id as bigint) % 89 <> 0",
}


def oracle() -> dict[str, str]:
    return {name: _query(body.strip()) for name, body in BODIES.items()}
