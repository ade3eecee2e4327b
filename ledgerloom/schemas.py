"""Column names and types of every table, in output order."""

from __future__ import annotations

ENTITIES = ("orders", "customers", "products", "order_items")

KEYS = {
    "orders": "order_id",
    "customers": "customer_id",
    "products": "product_id",
    "order_items": "item_id",
}

# Types the raw text is parsed into. The raw files themselves are all text.
ENTITY_TYPES = {
    "orders": {
        "order_id": "string", "customer_id": "string", "status": "string",
        "subtotal": "double", "shipping": "double", "total": "double",
        "currency": "string", "created_at": "timestamp", "updated_at": "timestamp",
        "channel": "string", "promo_code": "string",
    },
    "customers": {
        "customer_id": "string", "name": "string", "email": "string", "country": "string",
        "signup_date": "date", "segment": "string", "phone": "string", "city": "string",
    },
    "products": {
        "product_id": "string", "name": "string", "category": "string", "price": "double",
        "cost": "double", "stock_qty": "int", "supplier": "string", "sku": "string",
        "rating": "double", "review_count": "int",
    },
    "order_items": {
        "item_id": "string", "order_id": "string", "product_id": "string", "quantity": "int",
        "unit_price": "double", "discount": "double", "line_total": "double",
        "created_at": "timestamp",
    },
}

DERIVED_TYPES = {
    "orders": {"order_date": "date", "order_hour": "int", "is_promoted": "boolean"},
    "customers": {},
    "products": {"margin_pct": "double", "is_low_stock": "boolean"},
    "order_items": {"line_total_recalc": "double", "total_mismatch": "boolean"},
}

SILVER_AUDIT_TYPES = {"processed_at": "timestamp", "job_date": "string", "date_partition": "string"}
GOLD_AUDIT_TYPES = {"updated_at": "timestamp", "date_partition": "string"}

SILVER_TYPES = {
    name: {**ENTITY_TYPES[name], **DERIVED_TYPES[name], **SILVER_AUDIT_TYPES} for name in ENTITIES
}

GOLD_TYPES = {
    "daily_revenue_summary": {
        "order_date": "date", "channel": "string", "total_orders": "bigint",
        "gross_revenue": "double", "promo_revenue": "double", "avg_item_value": "double",
        "total_items_sold": "bigint", "total_units": "bigint", "aov": "double",
        "promo_pct": "double", **GOLD_AUDIT_TYPES,
    },
    "customer_rfm": {
        "customer_id": "string", "last_order_date": "date", "frequency": "bigint",
        "monetary": "double", "recency_days": "int", "r_score": "int", "f_score": "int",
        "m_score": "int", "rfm_score": "int", "rfm_segment": "string", "country": "string",
        "segment": "string", "signup_date": "date", **GOLD_AUDIT_TYPES,
    },
    "product_performance": {
        "product_id": "string", "units_sold": "bigint", "revenue": "double",
        "order_count": "bigint", "avg_discount": "double", "last_sold_date": "date",
        "name": "string", "category": "string", "price": "double", "cost": "double",
        "margin_pct": "double", "rating": "double", "review_count": "int",
        "is_low_stock": "boolean", "rank_by_revenue": "int", "rank_by_units": "int",
        **GOLD_AUDIT_TYPES,
    },
    "geo_revenue": {
        "country": "string", "order_date": "date", "revenue": "double", "orders": "bigint",
        "unique_customers": "bigint", "aov": "double", **GOLD_AUDIT_TYPES,
    },
    "order_status_funnel": {
        "order_date": "date", "status": "string", "order_count": "bigint",
        "total_value": "double", **GOLD_AUDIT_TYPES,
    },
}

# Partition column and in-file sort of each business table.
GOLD_LAYOUT = {
    "daily_revenue_summary": ("order_date", ["order_date", "channel"]),
    "customer_rfm": ("date_partition", []),
    "product_performance": ("category", []),
    "geo_revenue": ("order_date", ["order_date", "country"]),
    "order_status_funnel": ("order_date", ["order_date", "status"]),
}

# The text files of the flat variant, in header order.
FLAT_GOLD_TYPES = {
    "daily_revenue": {
        "order_date": "string", "channel": "string", "total_orders": "bigint",
        "gross_revenue": "double", "total_units": "bigint", "aov": "double",
    },
    "geo_revenue": {"country": "string", "orders": "bigint", "revenue": "double"},
    "order_funnel": {"status": "string", "order_count": "bigint"},
}

# The domains the quality checks compare against.
STATUSES = ["pending", "processing", "shipped", "delivered", "cancelled", "returned"]
CHANNELS = ["web", "mobile", "api"]
SEGMENTS = ["Bronze", "Silver", "Gold", "Platinum"]
COUNTRIES = ["US", "UK", "CA", "AU", "DE", "FR", "IN", "JP", "BR", "MX"]


def ddl(types: dict[str, str]) -> str:
    """A DDL schema string for readers and CREATE TABLE."""
    return ", ".join(f"`{name}` {kind}" for name, kind in types.items())


def raw_ddl(table: str) -> str:
    """The all-text schema of one raw entity."""
    return ddl({name: "string" for name in ENTITY_TYPES[table]})
