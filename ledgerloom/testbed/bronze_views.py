"""Raw order tables made from the test tables, as SQL that Spark and DuckDB read alike.

The test tables are clean, so the views plant defects by key arithmetic: padded and mixed-case
text, missing keys, totals that are no amount or negative, bad e-mails, zero prices and
quantities, and second versions of orders. Every row of the test tables is used.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = date(2001, 8, 1)

# The tables each view reads.
INPUTS = {
    "orders": ["orders"],
    "customers": ["customer", "nation"],
    "products": ["part"],
    "order_items": ["lineitem"],
}

VIEWS = {
    "orders": """
with b as (
  select *, cast(case o_orderkey % 4 when 0 then '0.00' when 1 then '4.99' when 2 then '9.99' else '14.99' end as decimal(18,2)) as ship
  from {orders})
select cast(o_orderkey as string) as order_id,
  case when o_orderkey % 97 = 0 then null else cast(o_custkey as string) end as customer_id,
  concat(' ', case when o_orderkey % 10 = 0 then 'Cancelled' when o_orderkey % 10 = 1 then 'RETURNED'
       when o_orderstatus = 'F' then 'Delivered' when o_orderstatus = 'O' then 'shipped'
       when o_orderkey % 2 = 0 then 'Pending' else 'processing' end, ' ') as status,
  cast(cast(o_totalprice as decimal(18,2)) as string) as subtotal,
  cast(ship as string) as shipping,
  case when o_orderkey % 101 = 0 then 'n/a' when o_orderkey % 103 = 0 then '-5.00'
       else cast(cast(cast(o_totalprice as decimal(18,2)) + ship as decimal(18,2)) as string) end as total,
  ' usd ' as currency,
  cast(o_orderdate as string) as created_at,
  cast(o_orderdate + cast(o_orderkey % 72 + 1 as int) * interval '1' hour as string) as updated_at,
  case when o_orderpriority = '1-URGENT' then 'API' when o_orderpriority in ('2-HIGH', '3-MEDIUM') then ' Web' else 'mobile ' end as channel,
  case when o_orderkey % 5 = 0 then concat('PROMO-', cast(o_orderkey % 10000 as string)) end as promo_code
from b
union all
select cast(o_orderkey as string), cast(o_custkey as string), ' Returned',
  cast(cast(o_totalprice as decimal(18,2)) as string), cast(ship as string),
  cast(cast(cast(o_totalprice as decimal(18,2)) + ship as decimal(18,2)) as string), 'USD',
  cast(o_orderdate as string),
  cast(o_orderdate + interval '100' hour as string), 'web', cast(null as string)
from b where o_orderkey % 20 = 3
""",
    "customers": """
select cast(c_custkey as string) as customer_id, c_name as name,
  case when c_custkey % 50 = 7 then 'not-an-email' else concat(' User', cast(c_custkey as string), '@Example.COM ') end as email,
  lower(n_name) as country,
  cast(cast('1993-01-01' as date) + cast(c_custkey % 700 as int) as string) as signup_date,
  lower(c_mktsegment) as segment,
  concat('555-', cast(c_custkey as string)) as phone, concat('city ', cast(c_nationkey as string)) as city
from {customer} join {nation} on c_nationkey = n_nationkey
""",
    "products": """
select cast(p_partkey as string) as product_id, p_name as name, lower(p_type) as category,
  case when p_partkey % 61 = 0 then '0.00' else cast(cast(p_retailprice as decimal(18,2)) as string) end as price,
  cast(cast(round(cast(p_retailprice as decimal(18,2)) * cast(case p_partkey % 3 when 0 then '0.30' when 1 then '0.55' else '0.70' end as decimal(4,2)), 2) as decimal(18,2)) as string) as cost,
  cast(p_partkey * 7 % 501 as string) as stock_qty, p_brand as supplier,
  concat(' sku-', cast(p_partkey as string)) as sku,
  cast(cast(1 as decimal(3,1)) + cast(cast(p_partkey % 41 as decimal(3,0)) * cast('0.1' as decimal(2,1)) as decimal(3,1)) as string) as rating,
  cast(p_partkey % 2001 as string) as review_count
from {part}
""",
    "order_items": """
select concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), cast(l_partkey as string), cast(l_suppkey as string)) as item_id,
  cast(l_orderkey as string) as order_id, cast(l_partkey as string) as product_id,
  case when l_orderkey % 211 = 0 then '0' else cast(cast(l_quantity as int) as string) end as quantity,
  cast(cast(cast(cast((cents - cents % qty) / qty as bigint) as decimal(16,0)) * cast('0.01' as decimal(3,2)) as decimal(18,2)) as string) as unit_price,
  cast(cast(l_discount as decimal(4,2)) as string) as discount,
  cast(cast(round(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2))), 2) as decimal(18,2)) as string) as line_total,
  cast(l_shipdate as string) as created_at
from (select *, cast(l_quantity as int) as qty, cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint) as cents from {lineitem}) l
""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw entity over the test tables in a folder."""
    return spark.sql(VIEWS[name], **{source: table(spark, sf_dir, source) for source in INPUTS[name]})


def raw_sql(name: str) -> str:
    """The same view as SQL text over tables of those names."""
    return VIEWS[name].format(**{source: source for source in INPUTS[name]})


# Days over which the backfill queries spread the raw rows, and the key that places a row.
SPREAD_DAYS = 30
SPREAD_KEYS = {"orders": "order_id", "customers": "customer_id", "products": "product_id",
               "order_items": "order_id"}


def raw_by_day(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """All raw rows, each with the ``date_partition`` it arrived on within the last 30 days."""
    back = F.col(SPREAD_KEYS[name]).cast("bigint") % SPREAD_DAYS
    return raw(spark, sf_dir, name).withColumn(
        "date_partition", F.date_format(F.date_sub(F.lit(AS_OF), back.cast("int")), "yyyy-MM-dd"))
