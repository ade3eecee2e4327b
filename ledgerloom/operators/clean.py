"""Raw text rows to typed, normalised, checked and deduplicated tables.

Every entity runs the same steps: parse by the declared types, normalise text, derive columns,
name the reason a row must be rejected, keep the rest, keep one row per key, add audit columns.
Filters come before the deduplication, so a rejected newer version leaves the older valid one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions.exact import RATE, money, parse, rate, ratio, rounded, too_large
from ledgerloom.operators.dedup import latest_by_key

# E-mail pattern, stock level that counts as low, tolerated line total difference.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
LOW_STOCK_BELOW = 10
LINE_TOTAL_TOLERANCE = "0.01"

REJECT, RAW = "reject_reason", "raw"


@dataclass(frozen=True)
class Entity:
    """How one table is cleaned."""

    name: str
    normalise: dict[str, Callable[[Column], Column]]
    derive: Callable[[], dict[str, Column]]
    reject: Callable[[], Column]
    newest: list[str] = field(default_factory=list)
    factors: Callable[[], dict[str, Column]] = dict

    @property
    def key(self) -> str:
        return schemas.KEYS[self.name]

    def derived(self, rows: DataFrame) -> DataFrame:
        """The rows with their derived columns; what several of them need is worked out once."""
        factors = self.factors()
        return rows.withColumns(factors).withColumns(self.derive()).drop(*factors)


def _lower(text: Column) -> Column:
    return F.lower(F.trim(text))


def _upper(text: Column) -> Column:
    return F.upper(F.trim(text))


def _capital(text: Column) -> Column:
    return F.initcap(F.trim(text))


def _order_columns() -> dict[str, Column]:
    return {
        "order_date": F.to_date("created_at"),
        "order_hour": F.hour("created_at"),
        "is_promoted": F.col("promo_code").isNotNull(),
    }


def _product_columns() -> dict[str, Column]:
    price, cost = money(F.col("price")), money(F.col("cost"))
    return {
        "margin_pct": F.when(price > 0, rounded(ratio((price - cost) * 100, price), 2)),
        "is_low_stock": F.col("stock_qty") < LOW_STOCK_BELOW,
    }


def _line_total_exact() -> Column:
    """quantity x unit price x (1 - discount) rounded once, to cents; null where a factor is too large.

    The two factors are narrowed so that their product keeps 15 decimals within 38 digits.
    """
    full_price = (F.col("quantity") * money(F.col("unit_price"))).try_cast("decimal(26,8)")
    share = (F.lit(1) - rate(F.col("discount"))).try_cast("decimal(12,8)")
    return F.round(full_price * share, 2)


def line_total_by_formula() -> Column:
    """quantity x unit price x (1 - discount) in cents, as double; exact unless a factor is too large for decimals."""
    plain = F.round(F.col("quantity") * F.col("unit_price") * (1 - F.col("discount")), 2)
    return F.coalesce(_line_total_exact().cast("double"), plain)


def line_total_gap() -> Column:
    """Distance of the stored line total from the one by the formula, as decimal where both fit."""
    exact = F.abs(money(F.col("line_total")) - _line_total_exact())
    return F.coalesce(exact.cast("double"), F.abs(F.col("line_total") - line_total_by_formula()))


def _item_factors() -> dict[str, Column]:
    return {"_exact": _line_total_exact()}


def _item_columns() -> dict[str, Column]:
    plain = F.round(F.col("quantity") * F.col("unit_price") * (1 - F.col("discount")), 2)
    recalc = F.coalesce(F.col("_exact").cast("double"), plain)
    gap = F.coalesce(F.abs(money(F.col("line_total")) - F.col("_exact")).cast("double"), F.abs(F.col("line_total") - recalc))
    return {
        "line_total_recalc": recalc,
        "total_mismatch": gap > F.lit(float(LINE_TOTAL_TOLERANCE)),
    }


def _order_reject() -> Column:
    return (F.when(F.col("order_id").isNull(), "missing order_id")
            .when(F.col("customer_id").isNull(), "missing customer_id")
            .when(F.col("total").isNull(), "total is no amount")
            .when(F.col("total") < 0, "negative total")
            .when(too_large(F.col("total")), "total too large to add up"))


def _customer_reject() -> Column:
    return (F.when(F.col("customer_id").isNull(), "missing customer_id")
            .when(~F.coalesce(F.col("email").rlike(EMAIL_PATTERN), F.lit(False)), "invalid email"))


def _product_reject() -> Column:
    return (F.when(F.col("product_id").isNull(), "missing product_id")
            .when(~F.coalesce(F.col("price") > 0, F.lit(False)), "price not positive"))


def _item_reject() -> Column:
    return (F.when(F.col("item_id").isNull(), "missing item_id")
            .when(F.col("order_id").isNull(), "missing order_id")
            .when(~F.coalesce(F.col("quantity") > 0, F.lit(False)), "quantity not positive")
            .when(too_large(F.col("line_total")), "line total too large to add up")
            .when(too_large(F.col("discount"), RATE), "discount too large to add up"))


CLEANERS = {
    entity.name: entity
    for entity in (
        Entity("orders", {"status": _lower, "currency": _upper, "channel": _lower},
               _order_columns, _order_reject, ["updated_at"]),
        Entity("customers", {"email": _lower, "country": _upper, "segment": _capital},
               dict, _customer_reject),
        Entity("products", {"category": _capital, "sku": _upper}, _product_columns, _product_reject),
        Entity("order_items", {}, _item_columns, _item_reject, factors=_item_factors),
    )
}


def parsed(table: str, raw: DataFrame) -> DataFrame:
    """Normalise text and parse it by the declared types; no row is dropped."""
    entity = CLEANERS[table]
    columns = {}
    for name, kind in schemas.ENTITY_TYPES[table].items():
        column = F.col(name)
        if name in entity.normalise:
            column = entity.normalise[name](column)
        columns[name] = parse(column, kind)
    return raw.withColumns(columns)


def typed(table: str, raw: DataFrame) -> DataFrame:
    """``parsed`` with the derived columns; no row is dropped."""
    return CLEANERS[table].derived(parsed(table, raw))


def quarantine(table: str, raw: DataFrame, processing_date: str | None = None) -> DataFrame:
    """The rows ``silver`` leaves out, with the first reason that applies.

    A ``date_partition`` column is added for a processing date, and kept where the rows bring one.
    """
    rows = typed(table, raw).withColumn(REJECT, CLEANERS[table].reject())
    names = [*schemas.ENTITY_TYPES[table], *schemas.DERIVED_TYPES[table], REJECT]
    if processing_date is not None:
        rows = rows.withColumn("date_partition", F.lit(processing_date))
    if "date_partition" in rows.columns:
        names.append("date_partition")
    return rows.filter(F.col(REJECT).isNotNull()).select(*names)


def instant(clock: datetime | None) -> Column:
    """The audit time: the given clock, or the time the query starts."""
    return F.current_timestamp() if clock is None else F.lit(clock).cast("timestamp")


def silver(table: str, raw: DataFrame, processing_date: str | None,
           clock: datetime | None = None) -> DataFrame:
    """The clean table of one entity.

    With ``processing_date`` all rows belong to that date. With None each row brings its own
    ``date_partition`` and one row is kept per date and key, as separate runs per date would.
    Of several rows with the same key, orders keep the latest ``updated_at``. Ties, and the other
    entities altogether, go to the highest row by all columns.
    """
    entity = CLEANERS[table]
    day = F.col("date_partition") if processing_date is None else F.lit(processing_date)
    names, keys = list(schemas.ENTITY_TYPES[table]), [entity.key]
    if processing_date is None:
        names, keys = [*names, "date_partition"], ["date_partition", *keys]
    rows = parsed(table, raw).withColumn(REJECT, entity.reject())
    rows = latest_by_key(rows.select(*names, REJECT), keys, entity.newest, F.col(REJECT).isNull())
    # Derived columns follow from the others, so they are added to the rows that are kept.
    return _audited(entity.derived(rows), day, clock).select(*schemas.SILVER_TYPES[table])


def _audited(rows: DataFrame, day: Column, clock: datetime | None) -> DataFrame:
    return rows.withColumns({"processed_at": instant(clock), "job_date": day, "date_partition": day})


CLEAN, REJECTED = "clean", "rejected"


def cleaned(table: str, raw: DataFrame, processing_date: str | None, clock: datetime | None = None) -> DataFrame:
    """The rows of ``silver`` and those it rejects from one scan of the raw rows, told apart by ``kind``.

    Rejected rows have a ``reject_reason``, and in ``raw`` the text of all their columns as it came; they are all
    kept, also those alike in every column.
    """
    entity, texts = CLEANERS[table], list(schemas.ENTITY_TYPES[table])
    day = F.col("date_partition") if processing_date is None else F.lit(processing_date)
    rows = raw.withColumns({"date_partition": day, RAW: F.struct(*texts)})
    rows = parsed(table, rows).withColumn(REJECT, entity.reject())
    rejected = F.col(REJECT).isNotNull()
    rows = rows.withColumns({RAW: F.when(rejected, F.col(RAW)), "_alone": F.when(rejected, F.monotonically_increasing_id())})
    keys = ["date_partition", entity.key, "_alone"]
    rows = latest_by_key(rows.select(*texts, "date_partition", REJECT, RAW, "_alone"), keys, entity.newest)
    rows = _audited(entity.derived(rows), F.col("date_partition"), clock)
    kind = F.when(F.col(REJECT).isNull(), CLEAN).otherwise(REJECTED).alias("kind")
    names = [name for name in schemas.SILVER_TYPES[table] if name != "date_partition"]
    return rows.select(*names, REJECT, RAW, kind, "date_partition")
