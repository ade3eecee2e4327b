"""The text-file variant of the tables: other rules, so other numbers and other names.

Revenue is the order total instead of the sum of the items, negative totals count by their
size, text that is no amount counts as 0, and orders are counted by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions.exact import TOTAL, money, parse_double, ratio, rounded, too_large
from ledgerloom.functions.text import strip, text_or_empty, title_words
from ledgerloom.operators.dedup import first_by_key, latest_by_key


def _lower(text: Column) -> Column:
    return strip(F.lower(text))


def _upper(text: Column) -> Column:
    return strip(F.upper(text))


def _amount(text: Column) -> Column:
    return F.coalesce(F.abs(parse_double(text)), F.lit(0.0))


RULES = {
    "orders": {"status": _lower, "currency": _upper, "channel": _lower, "total": _amount},
    "customers": {"email": _lower, "country": _upper},
    "products": {"category": lambda text: title_words(strip(text)), "sku": _upper},
    "order_items": {},
}


def not_blank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows whose every column is null or white space."""
    filled = [F.length(strip(text_or_empty(F.col(name)))) > 0 for name in columns]
    keep = filled[0]
    for test in filled[1:]:
        keep = keep | test
    return df.filter(keep)


def flat_clean(table: str, raw: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """Normalised text rows, the first per key in order of the ``arrival`` columns.

    ``arrival`` names columns that give the order of the rows in the files; those that are no
    columns of the table are dropped afterwards. Nulls become empty text.
    """
    key = schemas.KEYS[table]
    names = list(schemas.ENTITY_TYPES[table])
    rows = not_blank(raw, names)
    order = {f"_arrival_{place}": F.col(name) for place, name in enumerate(arrival)}
    clean = {name: RULES[table].get(name, lambda text: text)(text_or_empty(F.col(name)))
             for name in names}
    rows = rows.withColumns(order).withColumns(clean).filter(F.col(key) != "")
    return first_by_key(rows.select(*names, *order), [key], list(order)).select(*names)


def _not_cancelled(orders: DataFrame) -> DataFrame:
    """A null status is kept here."""
    return orders.filter(~F.col("status").eqNullSafe("cancelled"))


def _amounts() -> dict[str, Column]:
    """Sums of the order totals: those that decimals hold, and the others as double."""
    value = parse_double(F.col("total"))
    return {"exact": F.coalesce(F.sum(money(value)), F.lit(0).cast(TOTAL)),
            "large": F.sum(F.when(too_large(value), value))}


def _revenue(exact: Column, large: Column) -> Column:
    return rounded(exact, 2) + F.coalesce(large, F.lit(0.0))


def flat_daily_revenue(orders: DataFrame) -> DataFrame:
    """Order count and order totals per day and channel. ``total_units`` is always 0."""
    daily = (_not_cancelled(orders)
             .groupBy(F.substring(text_or_empty(F.col("created_at")), 1, 10).alias("order_date"),
                      F.coalesce("channel", F.lit("unknown")).alias("channel"))
             .agg(F.count(F.lit(1)).alias("total_orders"), *(sums.alias(name) for name, sums in _amounts().items())))
    mean = rounded(ratio(F.round("exact", 2), F.col("total_orders")), 2)
    return daily.select("order_date", "channel", "total_orders",
                        _revenue(F.col("exact"), F.col("large")).alias("gross_revenue"),
                        F.lit(0).cast("bigint").alias("total_units"),
                        (mean + F.coalesce(F.col("large") / F.col("total_orders"), F.lit(0.0))).alias("aov"))


def flat_geo_revenue(orders: DataFrame, customers: DataFrame,
                     arrival: Sequence[str] = ()) -> DataFrame:
    """Order count and totals per country; orders of unknown customers go to "Unknown".

    Of several rows of one customer the last by the ``arrival`` columns gives the country.
    """
    lookup = latest_by_key(customers.select("customer_id", "country", *arrival),
                           ["customer_id"], list(arrival)).select("customer_id", "country")
    per_customer = (_not_cancelled(orders).groupBy("customer_id")
                    .agg(F.count(F.lit(1)).alias("orders"), *(sums.alias(name) for name, sums in _amounts().items())))
    return (per_customer.join(lookup, "customer_id", "left")
            .groupBy(F.coalesce("country", F.lit("Unknown")).alias("country"))
            .agg(F.sum("orders").alias("orders"), _revenue(F.sum("exact"), F.sum("large")).alias("revenue")))


def flat_order_funnel(orders: DataFrame) -> DataFrame:
    """Orders per status over all dates."""
    return (orders.groupBy(F.coalesce("status", F.lit("unknown")).alias("status"))
            .agg(F.count(F.lit(1)).alias("order_count")))
