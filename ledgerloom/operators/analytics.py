"""Reports over the business tables. ``as_of`` stands for today."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.exact import ratio, rounded, total


def _since(as_of: date, days: int) -> Column:
    """Bound on the partition column itself, so whole partitions are skipped."""
    return F.col("order_date") >= F.date_sub(F.lit(as_of), days)


def _exact(name: str) -> Column:
    return total(F.col(name))


def _mean(name: str, digits: int) -> Column:
    return rounded(ratio(F.sum(_exact(name)), F.count(name)), digits)


def revenue_overview(daily: DataFrame, as_of: date) -> DataFrame:
    """Revenue per day of the last 30 days. The averages are over the channels of the day."""
    mean_aov = F.try_divide(F.sum(_exact("aov")).cast("double"), F.count("aov"))
    return (daily.filter(_since(as_of, 30)).groupBy("order_date")
            .agg(F.sum(_exact("gross_revenue")).cast("double").alias("total_revenue"),
                 F.sum("total_orders").alias("total_orders"),
                 mean_aov.alias("avg_order_value"),
                 F.sum("total_items_sold").alias("items_sold"),
                 _mean("promo_pct", 1).alias("avg_promo_pct"))
            .orderBy(F.desc("order_date")))


def revenue_by_channel(daily: DataFrame, as_of: date) -> DataFrame:
    """Revenue per channel of the last 7 days. ``aov`` is the mean of the daily means."""
    return (daily.filter(_since(as_of, 7)).groupBy("channel")
            .agg(F.sum("total_orders").alias("orders"),
                 F.sum(_exact("gross_revenue")).cast("double").alias("revenue"),
                 _mean("aov", 2).alias("aov"))
            .orderBy(F.desc_nulls_last("revenue"), "channel"))


def wow_growth(daily: DataFrame, as_of: date) -> DataFrame:
    """Weekly revenue of the last 90 days against the previous row, which is the last week with sales."""
    weekly = (daily.filter(_since(as_of, 90))
              .groupBy(F.date_trunc("week", "order_date").cast("date").alias("week_start"))
              .agg(F.sum(_exact("gross_revenue")).alias("amount")))
    # At most 14 rows, one per week of the 90 days.
    previous = F.lag("amount").over(Window.orderBy("week_start"))
    return (weekly.withColumn("previous", previous)
            .select("week_start", F.col("amount").cast("double").alias("revenue"),
                    F.col("previous").cast("double").alias("prev_week_revenue"),
                    rounded(ratio((F.col("amount") - F.col("previous")) * 100, F.col("previous")), 1)
                    .alias("wow_growth_pct"))
            .orderBy(F.desc("week_start")))


def top_products(performance: DataFrame, ranks: int = 10) -> DataFrame:
    """Products up to a revenue rank; ties may give more rows."""
    return (performance.filter(F.col("rank_by_revenue") <= ranks)
            .select("product_id", "name", "category", "units_sold",
                    rounded(_exact("revenue"), 2).alias("revenue"), "order_count",
                    rounded(_exact("margin_pct"), 1).alias("margin_pct"),
                    rounded(_exact("rating"), 1).alias("rating"), "rank_by_revenue")
            .orderBy("rank_by_revenue", "product_id"))


def low_stock_alert(performance: DataFrame, rows: int = 20) -> DataFrame:
    """The products low on stock with the highest revenue."""
    return (performance.filter(F.col("is_low_stock"))
            .select("product_id", "name", "category", "units_sold",
                    rounded(_exact("revenue"), 2).alias("revenue"), "rank_by_revenue")
            .orderBy(F.desc_nulls_last("revenue"), "product_id").limit(rows))


def segment_distribution(rfm: DataFrame) -> DataFrame:
    """Customers, averages and revenue per customer segment."""
    return (rfm.groupBy("rfm_segment")
            .agg(F.count("customer_id").alias("customer_count"),
                 _mean("monetary", 2).alias("avg_lifetime_value"),
                 _mean("recency_days", 0).alias("avg_recency_days"),
                 _mean("frequency", 1).alias("avg_orders"),
                 rounded(F.sum(_exact("monetary")), 2).alias("total_revenue_contribution"))
            .orderBy(F.desc_nulls_last("total_revenue_contribution"), "rfm_segment"))


def top_countries(geo: DataFrame, as_of: date, rows: int = 15) -> DataFrame:
    """Countries by revenue of the last 30 days.

    ``unique_customers`` adds up daily counts, so a customer counts once per day with orders;
    ``avg_aov`` is the mean of the daily means.
    """
    return (geo.filter(_since(as_of, 30)).groupBy("country")
            .agg(F.sum(_exact("revenue")).cast("double").alias("total_revenue"),
                 F.sum("orders").alias("total_orders"),
                 F.sum("unique_customers").alias("unique_customers"),
                 _mean("aov", 2).alias("avg_aov"))
            .orderBy(F.desc_nulls_last("total_revenue"), "country").limit(rows))


def funnel_share(funnel: DataFrame, as_of: date) -> DataFrame:
    """Orders, value and share of all orders per status of the last 7 days."""
    recent = funnel.filter(_since(as_of, 7))
    everything = recent.agg(F.sum("order_count").alias("grand_total")).scalar()
    return (recent.groupBy("status")
            .agg(F.sum("order_count").alias("orders"),
                 rounded(F.sum(_exact("total_value")), 2).alias("value"))
            .withColumn("pct_of_total",
                        rounded(ratio(F.col("orders").cast("decimal(20,0)") * 100, everything), 1))
            .orderBy(F.desc("orders"), "status"))


def champions(rfm: DataFrame, rows: int = 50) -> DataFrame:
    """The customers of the best segment with the highest spending."""
    return (rfm.filter(F.col("rfm_segment") == "Champions")
            .select("customer_id", "rfm_segment", "recency_days", "frequency",
                    rounded(_exact("monetary"), 2).alias("lifetime_value"),
                    "rfm_score", "country", "last_order_date")
            .orderBy(F.desc_nulls_last("lifetime_value"), "customer_id").limit(rows))


def silver_quality(orders: DataFrame, as_of: date) -> DataFrame:
    """Row, order and null counts per processing date of the last 7 days."""
    bound = F.date_format(F.date_sub(F.lit(as_of), 7), "yyyy-MM-dd")
    return (orders.filter(F.col("date_partition") >= bound).groupBy("date_partition")
            .agg(F.count(F.lit(1)).alias("row_count"),
                 F.count_distinct("order_id").alias("unique_orders"),
                 F.count_if(F.col("total").isNull()).alias("null_totals"),
                 F.min("total").alias("min_total"), F.max("total").alias("max_total"))
            .orderBy(F.desc("date_partition")))


def latest_daily_revenue(daily: DataFrame, rows: int = 30) -> DataFrame:
    """The newest rows of the daily table."""
    return daily.orderBy(F.desc_nulls_last("order_date"), "channel").limit(rows)
