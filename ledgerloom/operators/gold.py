"""Business tables over the clean tables.

All builders expect one row per key in each clean table (``silver`` and ``read_current`` give
that) and reduce rows per key before any join. A join therefore meets each hot order or customer
once per joined key, and distinct counts become plain counts of rows that are distinct already.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions.exact import money, rate, ratio, rounded
from ledgerloom.operators.clean import instant
from ledgerloom.operators.rank import global_rank, quantiles, sketched_quantiles
from ledgerloom.sources.staging import stage

# Least sum of the three scores per segment.
SEGMENTS = {"Champions": 10, "Loyal Customers": 8, "Potential Loyalists": 6, "At Risk": 4}
REST = "Lost"


def _not_cancelled(orders: DataFrame) -> DataFrame:
    """Null status fails the comparison, so it is left out as well."""
    return orders.filter(F.col("status") != "cancelled")


def _finish(df: DataFrame, table: str, processing_date: str, clock: datetime | None) -> DataFrame:
    return (df.withColumns({"updated_at": instant(clock), "date_partition": F.lit(processing_date)})
            .select(*schemas.GOLD_TYPES[table]))


def daily_revenue_summary(orders: DataFrame, order_items: DataFrame, processing_date: str,
                          clock: datetime | None = None) -> DataFrame:
    """Revenue of the items per order date and channel.

    ``promo_revenue`` is null where no promoted item with a line total exists. ``aov`` and
    ``promo_pct`` are taken from the rounded revenues.
    """
    per_order = order_items.groupBy("order_id").agg(
        F.sum(money(F.col("line_total"))).alias("amount"),
        F.count("line_total").alias("amounts"),
        F.count("item_id").alias("items"),
        F.sum(F.col("quantity").cast("bigint")).alias("units"))
    live = _not_cancelled(orders).select("order_id", "order_date", "channel", "is_promoted")
    daily = (per_order.join(live, "order_id")
             .groupBy("order_date", "channel")
             .agg(F.count(F.lit(1)).alias("total_orders"),
                  F.round(F.sum("amount"), 2).alias("gross"),
                  F.round(F.sum(F.when(F.col("is_promoted"), F.col("amount"))), 2).alias("promo"),
                  rounded(ratio(F.sum("amount"), F.sum("amounts")), 2).alias("avg_item_value"),
                  F.sum("items").alias("total_items_sold"),
                  F.sum("units").alias("total_units")))
    daily = daily.withColumns({
        "gross_revenue": F.col("gross").cast("double"),
        "promo_revenue": F.col("promo").cast("double"),
        "aov": rounded(ratio(F.col("gross"), F.col("total_orders")), 2),
        "promo_pct": rounded(ratio(F.col("promo") * 100, F.col("gross").try_cast("decimal(22,2)")), 1),
    })
    return _finish(daily, "daily_revenue_summary", processing_date, clock)


def _score(value: str, quartiles: str, low_is_good: bool) -> Column:
    """4 for the best quarter down to 1; ``quartiles`` is an array column of the three bounds."""
    bounds = [F.element_at(F.col(quartiles), place) for place in (1, 2, 3)]
    if low_is_good:
        tests = [F.col(value) <= bound for bound in bounds]
    else:
        tests = [F.col(value) >= bound for bound in reversed(bounds)]
    return F.when(tests[0], 4).when(tests[1], 3).when(tests[2], 2).otherwise(1)


def customer_rfm(orders: DataFrame, customers: DataFrame, processing_date: str,
                 clock: datetime | None = None, folder: str | None = None, sketched: bool = False) -> DataFrame:
    """Recency, frequency and monetary scores per customer, and the segment they add up to.

    The quartiles are exact, so the scores are the same on any cluster. They are a scalar subquery, so nothing
    passes through the driver program, and an empty input gives an empty table. ``folder`` is where tables are staged.
    With ``sketched`` quartiles come from one aggregate of sketches instead, within their rank error.
    """
    today, last = F.lit(processing_date).cast("date"), F.max("order_date")
    per_customer = stage(_not_cancelled(orders).groupBy("customer_id").agg(
        F.count("order_id").alias("frequency"),
        rounded(F.sum(money(F.col("total"))), 2).alias("monetary"),
        last.alias("last_order_date"),
        F.date_diff(today, last).alias("recency_days")), "per-customer", folder)
    values, points = ["frequency", "monetary", "recency_days"], [0.25, 0.5, 0.75]
    bounds = sketched_quantiles(per_customer, values, points) if sketched else quantiles(per_customer, values, points, folder)
    segment = F.lit(REST)
    for name, least in sorted(SEGMENTS.items(), key=lambda item: item[1]):
        segment = F.when(F.col("rfm_score") >= least, name).otherwise(segment)
    scored = (per_customer.withColumn("bounds", bounds.select(F.struct("*")).scalar())
              .withColumns({"r_score": _score("recency_days", "bounds.recency_days", True),
                            "f_score": _score("frequency", "bounds.frequency", False),
                            "m_score": _score("monetary", "bounds.monetary", False)})
              .withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
              .withColumn("rfm_segment", segment))
    known = customers.select("customer_id", "country", "segment", "signup_date")
    return _finish(scored.join(known, "customer_id", "left"), "customer_rfm", processing_date, clock)


def product_sales(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Units, revenue, orders, discount and last sale per product over orders not cancelled."""
    per_order = order_items.groupBy("order_id", "product_id").agg(
        F.sum(F.col("quantity").cast("bigint")).alias("units"),
        F.sum(money(F.col("line_total"))).alias("amount"),
        F.sum(rate(F.col("discount"))).alias("discounts"),
        F.count("discount").alias("discounted"))
    live = _not_cancelled(orders).select("order_id", "order_date")
    return (per_order.join(live, "order_id")
            .groupBy("product_id")
            .agg(F.sum("units").alias("units_sold"),
                 rounded(F.sum("amount"), 2).alias("revenue"),
                 F.count(F.lit(1)).alias("order_count"),
                 rounded(ratio(F.sum("discounts"), F.sum("discounted")), 4).alias("avg_discount"),
                 F.max("order_date").alias("last_sold_date")))


def product_performance(order_items: DataFrame, orders: DataFrame, products: DataFrame,
                        processing_date: str, clock: datetime | None = None,
                        folder: str | None = None) -> DataFrame:
    """Sales per product with its attributes and its rank by revenue and by units.

    Products without sales are absent; sold products the product table lacks have null attributes.
    """
    attributes = products.select("product_id", "name", "category", "price", "cost", "margin_pct",
                                 "rating", "review_count", "is_low_stock")
    sold = product_sales(order_items, orders).join(attributes, "product_id", "left")
    ranked = global_rank(sold, {"rank_by_revenue": "revenue", "rank_by_units": "units_sold"}, folder)
    # the table's ranks are int; products are far fewer
    ranked = ranked.withColumns({name: F.col(name).cast("int") for name in ("rank_by_revenue", "rank_by_units")})
    return _finish(ranked, "product_performance", processing_date, clock)


def geo_revenue(orders: DataFrame, customers: DataFrame, processing_date: str,
                clock: datetime | None = None) -> DataFrame:
    """Order totals per country and date; customers that are not known form the null country."""
    per_customer = (_not_cancelled(orders).groupBy("customer_id", "order_date")
                    .agg(F.sum(money(F.col("total"))).alias("amount"),
                         F.count("total").alias("amounts"),
                         F.count("order_id").alias("orders")))
    geo = (per_customer.join(customers.select("customer_id", "country"), "customer_id", "left")
           .groupBy("country", "order_date")
           .agg(rounded(F.sum("amount"), 2).alias("revenue"),
                F.sum("orders").alias("orders"),
                F.count("customer_id").alias("unique_customers"),
                rounded(ratio(F.sum("amount"), F.sum("amounts")), 2).alias("aov")))
    return _finish(geo, "geo_revenue", processing_date, clock)


def order_status_funnel(orders: DataFrame, processing_date: str,
                        clock: datetime | None = None) -> DataFrame:
    """Orders and their value per date and status, cancelled ones included."""
    funnel = (orders.groupBy("order_date", "status")
              .agg(F.count("order_id").alias("order_count"),
                   rounded(F.sum(money(F.col("total"))), 2).alias("total_value")))
    return _finish(funnel, "order_status_funnel", processing_date, clock)
