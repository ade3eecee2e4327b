"""Jobs over the raw, clean and business layers."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import flat, gold, report
from ledgerloom.operators.clean import CLEAN, REJECTED, cleaned
from ledgerloom.sources import bronze, tables
from ledgerloom.sources.staging import fresh_folder, remove_folder, stage

MAX_BACKFILL_DAYS = 30


def yesterday(now: datetime | None = None) -> date:
    """The default processing date, in UTC."""
    return ((now or datetime.now(UTC)) - timedelta(days=1)).date()


def _clean_all(spark: SparkSession, root: str, days: list[date | str], read: Callable[[str], DataFrame],
               processing_date: str | None, clock: datetime | None) -> DataFrame:
    """Write the clean and the rejected rows of the four tables, each from one scan; gives the rows per table."""
    written = {table: tables.write_cleaned(cleaned(table, read(table), processing_date, clock), root, table, days)
               for table in schemas.ENTITIES}
    return (tables.run_summary(spark, "silver", {table: counts[CLEAN] for table, counts in written.items()})
            .unionByName(tables.run_summary(spark, "rejected", {table: counts[REJECTED] for table, counts in written.items()})))


def run_silver(spark: SparkSession, raw_root: str, silver_root: str, day: date | str | None = None,
               clock: datetime | None = None, file_format: str = "csv") -> DataFrame:
    """Clean the four raw tables of one date; gives the rows written per table."""
    processing_date = str(day or yesterday())
    return _clean_all(spark, silver_root, [processing_date],
                      lambda table: bronze.read_day(spark, raw_root, table, processing_date, file_format),
                      processing_date, clock)


def run_range(spark: SparkSession, raw_root: str, silver_root: str, start: date, end: date,
              clock: datetime | None = None, file_format: str = "csv",
              max_days: int = MAX_BACKFILL_DAYS) -> DataFrame:
    """Clean the four raw tables of a range of dates, both ends included, in one job per table.

    The result equals separate runs per date. Partitions of the range are replaced, so it can be
    repeated; a range longer than ``max_days`` is refused.
    """
    length = (end - start).days + 1
    if length < 1:
        raise ValueError(f"range ends before it starts: {start} to {end}")
    if length > max_days:
        raise ValueError(f"range of {length} days exceeds the limit of {max_days}")
    return _clean_all(spark, silver_root, [start + timedelta(days=back) for back in range(length)],
                      lambda table: bronze.read_days(spark, raw_root, table, start, end, file_format),
                      None, clock)


def run_gold(spark: SparkSession, silver_root: str, gold_root: str, day: date | str | None = None,
             clock: datetime | None = None) -> DataFrame:
    """Rebuild the five business tables from all clean rows; gives the rows written per table.

    Orders and items feed several tables, so their valid rows are worked out once and staged with
    only the columns the builders read. The staged tables are removed at the end.
    """
    processing_date, work = str(day or yesterday()), fresh_folder(spark, "gold")

    def current(table: str, *columns: str) -> DataFrame:
        return tables.read_current(spark, silver_root, table, list(columns))

    try:
        orders = stage(current("orders", "order_id", "customer_id", "status", "total", "channel",
                               "order_date", "is_promoted"), "orders", work)
        items = stage(current("order_items", "item_id", "order_id", "product_id", "quantity", "discount",
                              "line_total"), "items", work)
        customers = current("customers", "customer_id", "country", "segment", "signup_date")
        products = current("products", "product_id", "name", "category", "price", "cost", "margin_pct",
                           "rating", "review_count", "is_low_stock")
        built = {
            "daily_revenue_summary": gold.daily_revenue_summary(orders, items, processing_date, clock),
            "customer_rfm": gold.customer_rfm(orders, customers, processing_date, clock, work),
            "product_performance": gold.product_performance(items, orders, products, processing_date, clock,
                                                            folder=work),
            "geo_revenue": gold.geo_revenue(orders, customers, processing_date, clock),
            "order_status_funnel": gold.order_status_funnel(orders, processing_date, clock),
        }
        counts = {table: tables.write_gold(rows, gold_root, table) for table, rows in built.items()}
    finally:
        remove_folder(spark, work)
    return tables.run_summary(spark, "gold", counts)


def run_flat_clean(spark: SparkSession, raw_root: str, silver_root: str, day: date | str) -> DataFrame:
    """Clean the raw text files of one date into text files of the same columns."""
    counts = {}
    for table in schemas.ENTITIES:
        raw = bronze.with_file_order(bronze.read_day(spark, raw_root, table, day))
        counts[table] = tables.write_flat_csv(flat.flat_clean(table, raw, bronze.FILE_ORDER),
                                              f"{silver_root}/flat_silver/{table}/dt={day}")
    return tables.run_summary(spark, "flat_silver", counts)


def run_flat_gold(spark: SparkSession, silver_root: str, gold_root: str, day: date | str) -> DataFrame:
    """The flat business tables over the text files of all dates; gives the rows written."""
    orders, customers = (
        bronze.with_file_order(bronze.read_csv(spark, f"{silver_root}/flat_silver/{table}",
                                               schemas.raw_ddl(table), recursive=True))
        for table in ("orders", "customers"))
    built = {
        "daily_revenue": flat.flat_daily_revenue(orders),
        "geo_revenue": flat.flat_geo_revenue(orders, customers, bronze.FILE_ORDER),
        "order_funnel": flat.flat_order_funnel(orders),
    }
    counts = {table: tables.write_flat_csv(rows, f"{gold_root}/flat_gold/{table}/dt={day}")
              for table, rows in built.items()}
    # every order is in the funnel once
    funnel = tables.read_flat_gold(spark, gold_root, "order_funnel", day) if counts["order_funnel"] else None
    processed = funnel.agg(F.sum("order_count")).first()[0] if funnel is not None else 0
    return tables.run_summary(spark, "flat_gold", {**counts, "orders_processed": int(processed)})


def run_report(spark: SparkSession, gold_root: str, day: date | str) -> dict[str, DataFrame]:
    """The four report tables over the flat business tables of one date."""
    daily, geo, funnel = (tables.read_flat_gold(spark, gold_root, table, day)
                          for table in ("daily_revenue", "geo_revenue", "order_funnel"))
    return {"channels": report.report_channels(daily), "countries": report.report_countries(geo),
            "funnel": report.report_funnel(funnel), "summary": report.report_summary(daily, geo)}
