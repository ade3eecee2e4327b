"""Small builders for raw rows."""

from ledgerloom import schemas

ORDER = {"order_id": "o1", "customer_id": "c1", "status": " Shipped ", "subtotal": "10.00", "shipping": "4.99",
         "total": "14.99", "currency": "usd ", "created_at": "2024-11-01T10:30:00",
         "updated_at": "2024-11-02 10:30:00", "channel": " WEB", "promo_code": None}
CUSTOMER = {"customer_id": "c1", "name": "Ann", "email": " Ann@Example.com ", "country": " us", "segment": "gold ",
            "signup_date": "2023-05-06", "phone": "1", "city": "x"}
PRODUCT = {"product_id": "p1", "name": "thing", "category": " home & kitchen", "price": "10.00", "cost": "6.00",
           "stock_qty": "9", "supplier": "s", "sku": " ab-1", "rating": "4.5", "review_count": "12"}
ITEM = {"item_id": "i1", "order_id": "o1", "product_id": "p1", "quantity": "2", "unit_price": "5.00",
        "discount": "0.10", "line_total": "9.00", "created_at": "2024-11-01 10:30:00"}
BASE = {"orders": ORDER, "customers": CUSTOMER, "products": PRODUCT, "order_items": ITEM}


def raw(spark, table, *changes):
    """One raw row per dict of changes to the base row of the table."""
    rows = [{**BASE[table], **change} for change in changes]
    names = list(schemas.ENTITY_TYPES[table])
    return spark.createDataFrame([tuple(row[name] for name in names) for row in rows], schemas.raw_ddl(table))


def dicts(df):
    return [row.asDict() for row in df.collect()]


def by(df, key):
    return {row[key]: row.asDict() for row in df.collect()}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    """Rows as a sorted list of tuples, nulls first."""
    frame = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in frame.collect()),
                  key=lambda row: [(value is not None, str(value)) for value in row])
