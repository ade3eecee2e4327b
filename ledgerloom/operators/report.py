"""The summary report over the flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.exact import ratio, rounded, total


def report_channels(daily: DataFrame) -> DataFrame:
    return (daily.groupBy("channel")
            .agg(F.sum("total_orders").alias("orders"),
                 F.sum(total(F.col("gross_revenue"))).cast("double").alias("revenue"))
            .orderBy(F.desc_nulls_last("revenue"), "channel"))


def report_countries(geo: DataFrame) -> DataFrame:
    return geo.select("country", "orders", "revenue").orderBy(F.desc_nulls_last("revenue"), "country")


def report_funnel(funnel: DataFrame) -> DataFrame:
    """Count, share in percent and a text bar with one mark per full two percent."""
    everything = funnel.agg(F.sum("order_count")).scalar()
    count = F.col("order_count").cast("decimal(20,0)")
    return (funnel.withColumn("everything", everything.cast("decimal(20,0)"))
            .select("status", "order_count",
                    rounded(ratio(count * 100, F.col("everything")), 1).alias("pct"),
                    F.repeat(F.lit("#"), F.floor(ratio(count * 50, F.col("everything"))).cast("int"))
                    .alias("bar"))
            .orderBy(F.desc("order_count"), "status"))


def report_summary(daily: DataFrame, geo: DataFrame) -> DataFrame:
    """One row over everything; ``countries`` is the number of rows of the country table."""
    countries = geo.agg(F.count(F.lit(1))).scalar()
    totals = daily.agg(F.sum("total_orders").alias("total_orders"),
                       F.sum(total(F.col("gross_revenue"))).alias("amount"),
                       F.count_distinct("channel").alias("channels"))
    return totals.select("total_orders", F.col("amount").cast("double").alias("total_revenue"),
                         rounded(ratio(F.col("amount"), F.col("total_orders")), 2).alias("avg_order_value"),
                         countries.alias("countries"), "channels")
