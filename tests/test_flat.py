from helpers import by, dicts, raw, rows
from ledgerloom.operators import flat, report


def test_clean_orders(spark):
    data = raw(spark, "orders", {"order_id": "a", "total": "-5.5", "status": "\tShipped\n"},
               {"order_id": "b", "total": "n/a", "customer_id": None, "status": None}, {"order_id": ""}, {"order_id": None})
    got = by(flat.flat_clean("orders", data, ["updated_at"]), "order_id")
    assert set(got) == {"a", "b"}
    assert (got["a"]["total"], got["a"]["status"], got["a"]["currency"], got["a"]["channel"]) == (5.5, "shipped", "USD", "web")
    assert (got["b"]["total"], got["b"]["customer_id"], got["b"]["status"], got["b"]["promo_code"]) == (0.0, "", "", "")


def test_first_row_of_a_key_stays(spark):
    data = raw(spark, "orders", {"status": "second", "updated_at": "2024-02"}, {"status": "first", "updated_at": "2024-01"})
    assert rows(flat.flat_clean("orders", data, ["updated_at"]), "status") == [("first",)]


def test_blank_rows_are_dropped(spark):
    blank = {name: " \t" for name in ("item_id", "order_id", "product_id", "quantity", "unit_price", "discount",
                                      "line_total", "created_at")}
    data = raw(spark, "order_items", blank, {name: None for name in blank}, {})
    assert flat.not_blank(data, data.columns).count() == 1


def test_clean_other_tables(spark):
    product = dicts(flat.flat_clean("products", raw(spark, "products", {"category": " o'neil GOODS "}), []))[0]
    assert (product["category"], product["sku"], product["price"]) == ("O'Neil Goods", "AB-1", "10.00")
    customer = dicts(flat.flat_clean("customers", raw(spark, "customers", {}), []))[0]
    assert (customer["email"], customer["country"], customer["segment"]) == ("ann@example.com", "US", "gold ")


def test_business_tables_and_report(spark):
    o = flat.flat_clean("orders", raw(
        spark, "orders", {"order_id": "a", "total": "10.00"}, {"order_id": "b", "total": "bad"},
        {"order_id": "c", "total": "-1.01", "customer_id": "c2"}, {"order_id": "d", "status": "Cancelled"},
        {"order_id": "e", "customer_id": "nobody", "created_at": "2024-11-02", "channel": "api"}), ["updated_at"])
    c = flat.flat_clean("customers", raw(spark, "customers", {}, {"customer_id": "c2", "country": "de"}), [])
    daily, geo, funnel = flat.flat_daily_revenue(o), flat.flat_geo_revenue(o, c), flat.flat_order_funnel(o)
    assert rows(daily) == [("2024-11-01", "web", 3, 11.01, 0, 3.67), ("2024-11-02", "api", 1, 14.99, 0, 14.99)]
    assert rows(geo) == [("DE", 1, 1.01), ("US", 2, 10.0), ("Unknown", 1, 14.99)]
    assert rows(funnel) == [("cancelled", 1), ("shipped", 4)]
    assert [tuple(row) for row in report.report_channels(daily).collect()] == [("api", 1, 14.99), ("web", 3, 11.01)]
    assert [row["country"] for row in report.report_countries(geo).collect()] == ["Unknown", "US", "DE"]
    assert [tuple(row) for row in report.report_funnel(funnel).collect()] == [
        ("shipped", 4, 80.0, "#" * 40), ("cancelled", 1, 20.0, "#" * 10)]
    assert rows(report.report_summary(daily, geo)) == [(4, 26.0, 6.5, 3, 2)]


def test_last_row_of_a_customer_gives_the_country(spark):
    o = flat.flat_clean("orders", raw(spark, "orders", {}), ["updated_at"])
    c = spark.createDataFrame([("c1", "US", 1), ("c1", "DE", 2)], "customer_id string, country string, at int")
    assert rows(flat.flat_geo_revenue(o, c, ["at"]), "country") == [("DE",)]


def test_missing_status_and_channel(spark):
    o = spark.createDataFrame([(None, None, "2024-11-01T10", "1.00")], "status string, channel string, created_at string, total string")
    assert rows(flat.flat_daily_revenue(o), "channel", "total_orders") == [("unknown", 1)]
    assert rows(flat.flat_order_funnel(o)) == [("unknown", 1)]
