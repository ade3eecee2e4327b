"""Business tables by order date, kept up to date without rebuilding all dates.

A clean row that is added, replaced or removed can change the figures of few order dates only: those of
all versions of its order (an order may move from one date to another), for items those of all orders their versions
belong to, for customers those of all their orders. These dates are found by keys over narrow
columns, and only their partitions are worked out and overwritten. The two tables whose scores and ranks compare all
customers or products are left to ``batch.run_gold``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import gold
from ledgerloom.operators.dedup import latest_by_key
from ledgerloom.sources import tables
from ledgerloom.sources.staging import folder_exists, fresh_folder, remove_folder, stage

DATED = ("daily_revenue_summary", "geo_revenue", "order_status_funnel")


def _versions(spark: SparkSession, root: str, table: str, *columns: str) -> DataFrame:
    return tables.read_silver(spark, root, table).select(*columns, "date_partition")


def affected_dates(spark: SparkSession, silver_root: str, days: Sequence[date | str]) -> DataFrame:
    """``order_date``: the order dates that the clean rows of some processing dates bear on; one of them may be null."""
    if not all(folder_exists(spark, tables.silver_path(silver_root, table)) for table in ("orders", "order_items", "customers")):
        return spark.createDataFrame([], "order_date date")
    among = F.col("date_partition").isin([str(day) for day in days])
    orders = _versions(spark, silver_root, "orders", "order_id", "customer_id", "order_date")
    items = _versions(spark, silver_root, "order_items", "item_id", "order_id")
    customers = _versions(spark, silver_root, "customers", "customer_id")
    changed_items = items.filter(among).select("item_id").distinct()
    keys = (orders.filter(among).select("order_id")
            .unionByName(items.join(changed_items, "item_id", "left_semi").select("order_id"))
            .unionByName(orders.join(customers.filter(among), "customer_id", "left_semi").select("order_id"))
            .distinct())
    return orders.join(keys, "order_id", "left_semi").select("order_date").distinct()


def _current(versions: DataFrame, key: str, newest: Sequence[str], wanted: DataFrame, on: str) -> DataFrame:
    """The valid row of every key that has a version with one of the wanted values; the valid row itself may have another."""
    keys = versions.join(wanted.withColumnRenamed(on, "_wanted"), versions[on].eqNullSafe(F.col("_wanted")), "left_semi").select(key).distinct()
    return latest_by_key(versions.join(keys, key, "left_semi"), [key], newest)


def rebuild_dates(spark: SparkSession, silver_root: str, gold_root: str, dates: DataFrame, day: date | str,
                  clock: datetime | None = None) -> DataFrame:
    """Work out the business tables by order date for some order dates only and overwrite those partitions.

    Gives the rows written per table. A date that has no rows any more loses its partition. Other dates stay as they are, with the
    audit columns of the run that wrote them.
    """
    processing_date, work = str(day), fresh_folder(spark, "gold-dates")
    try:
        dates = stage(dates.select("order_date").distinct(), "dates", work)
        orders = _current(_versions(spark, silver_root, "orders", "order_id", "customer_id", "status", "total", "channel", "order_date",
                                    "is_promoted", "updated_at"), "order_id", ["updated_at", "date_partition"], dates, "order_date")
        orders = stage(orders.join(dates.withColumnRenamed("order_date", "_date"), F.col("order_date").eqNullSafe(F.col("_date")), "left_semi")
                       .drop("updated_at", "date_partition"), "orders", work)
        items = _current(_versions(spark, silver_root, "order_items", "item_id", "order_id", "product_id", "quantity", "line_total"),
                         "item_id", ["date_partition"], orders.select("order_id").distinct(), "order_id")
        customers = _current(_versions(spark, silver_root, "customers", "customer_id", "country"), "customer_id", ["date_partition"],
                             orders.select("customer_id").distinct(), "customer_id")
        built = {
            "daily_revenue_summary": gold.daily_revenue_summary(orders, items, processing_date, clock),
            "geo_revenue": gold.geo_revenue(orders, customers, processing_date, clock),
            "order_status_funnel": gold.order_status_funnel(orders, processing_date, clock),
        }
        counts = {table: tables.replace_gold_dates(stage(built[table], table, work), gold_root, table, dates) for table in DATED}
    finally:
        remove_folder(spark, work)
    return tables.run_summary(spark, "gold", counts)


def refresh(spark: SparkSession, silver_root: str, gold_root: str, days: Sequence[date | str], clean: Callable[[], DataFrame],
            day: date | str, clock: datetime | None = None) -> DataFrame:
    """Run ``clean``, which writes the clean rows of some processing dates, and bring the tables by order date up to date.

    The dates that the rows of ``days`` bear on are taken before and after, so rows that a repeated run replaces or
    leaves out count too. Gives the rows written per table of both.
    """
    work = fresh_folder(spark, "refresh")
    try:
        before = stage(affected_dates(spark, silver_root, days), "before", work)
        written = clean()
        dates = before.unionByName(affected_dates(spark, silver_root, days))
        return written.unionByName(rebuild_dates(spark, silver_root, gold_root, dates, day, clock))
    finally:
        remove_folder(spark, work)
