"""Data-quality checks: each gives the violating rows; a summary counts them per check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions.exact import money
from ledgerloom.operators.clean import line_total_gap

# Tolerances of the amount checks.
TOTAL_TOLERANCE = "0.01"
LINE_TOLERANCE = "0.02"


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns the table lacks."""
    return [name for name in required if name not in df.columns]


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1))


def orphans(df: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` has no match in the parent table.

    The join meets all rows, so a hot value is left to adaptive skew splitting; nothing may stand between the
    join and its exchanges, or Spark does not split.
    """
    return df.join(parent.select(column), column, "left_anti")


def orphan_tally(df: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """One row (failed, total) counting orphans; rows are counted per key before the join."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    known = parent.select(column).distinct().withColumn("known", F.lit(True))
    return (counts.join(known, column, "left")
            .agg(F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("rows"))), F.lit(0)).alias("failed"),
                 F.coalesce(F.sum("rows"), F.lit(0)).alias("total")))


def not_in(column: str, allowed: Sequence[str]) -> Column:
    """A value outside the set; null counts as outside."""
    return ~F.coalesce(F.col(column).isin(list(allowed)), F.lit(False))


def total_below_subtotal(tolerance: str = TOTAL_TOLERANCE) -> Column:
    exact = money(F.col("total")) < money(F.col("subtotal")) - F.lit(tolerance).cast("decimal(18,4)")
    return F.coalesce(exact, F.col("total") < F.col("subtotal") - float(tolerance))


def line_total_off(tolerance: str = LINE_TOLERANCE) -> Column:
    """Off by the tolerance or more."""
    return line_total_gap() >= F.lit(float(tolerance))


def row_checks(segments: Sequence[str] = schemas.SEGMENTS,
               countries: Sequence[str] = schemas.COUNTRIES) -> dict[str, dict[str, Column]]:
    """Per table, the condition a violating row meets, by check name."""
    return {
        "orders": {
            "orders_status_known": not_in("status", schemas.STATUSES),
            "orders_channel_known": not_in("channel", schemas.CHANNELS),
            "orders_total_not_negative": F.col("total") < 0,
            "orders_total_covers_subtotal": total_below_subtotal(),
        },
        "customers": {
            "customers_segment_known": not_in("segment", segments),
            "customers_country_known": not_in("country", countries),
        },
        "products": {
            "products_price_positive": F.col("price") <= 0,
            "products_cost_positive": F.col("cost") <= 0,
            "products_cost_below_price": F.col("cost") >= F.col("price"),
            "products_stock_not_negative": F.col("stock_qty") < 0,
        },
        "order_items": {"items_line_total_matches": line_total_off()},
    }


# Per table, the columns whose values must be unique, by check name.
UNIQUE_CHECKS = {
    "orders": {"orders_key_unique": "order_id"},
    "customers": {"customers_key_unique": "customer_id", "customers_email_unique": "email"},
    "products": {"products_key_unique": "product_id"},
    "order_items": {"items_key_unique": "item_id"},
}


def violations(df: DataFrame, failed: Column) -> DataFrame:
    """The rows that meet a violation condition; an unknown outcome is no violation."""
    return df.filter(failed)


def _row_summary(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """All row conditions of one table in one pass over it."""
    counts = df.agg(F.count(F.lit(1)).alias("total"),
                    *[F.count_if(failed).alias(name) for name, failed in checks.items()])
    entries = F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(name).alias("failed"))
                        for name in checks])
    return counts.select(F.inline(entries), "total")


def _unique_summary(df: DataFrame, name: str, column: str) -> DataFrame:
    """``failed`` counts the values that occur more than once, ``total`` all different values."""
    counts = (df.filter(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("occurrences")))
    return counts.agg(F.count_if(F.col("occurrences") > 1).alias("failed"),
                      F.count(F.lit(1)).alias("total")).select(F.lit(name).alias("check_name"), "failed", "total")


def dq_summary(tables: dict[str, DataFrame], segments: Sequence[str] = schemas.SEGMENTS,
               countries: Sequence[str] = schemas.COUNTRIES) -> DataFrame:
    """(check_name, failed, total) of every check over the four tables."""
    parts = []
    for table, checks in row_checks(segments, countries).items():
        parts.append(_row_summary(tables[table], checks))
    for table, unique in UNIQUE_CHECKS.items():
        parts += [_unique_summary(tables[table], name, column) for name, column in unique.items()]
    parts.append(orphan_tally(tables["order_items"], tables["orders"], "order_id")
                 .select(F.lit("items_order_exists").alias("check_name"), "failed", "total"))
    summary = parts[0]
    for part in parts[1:]:
        summary = summary.unionByName(part)
    return summary
