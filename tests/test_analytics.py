from datetime import date, timedelta

from helpers import by, dicts, rows
from ledgerloom import schemas
from ledgerloom.operators import analytics

AS_OF = date(2024, 11, 10)


def table(spark, name, *changes):
    """Business rows with only the given columns filled."""
    names = list(schemas.GOLD_TYPES[name])
    return spark.createDataFrame([tuple(change.get(column) for column in names) for change in changes],
                                 schemas.ddl(schemas.GOLD_TYPES[name]))


def day(back, **columns):
    return {"order_date": AS_OF - timedelta(days=back), **columns}


def test_revenue_overview(spark):
    daily = table(spark, "daily_revenue_summary",
                  day(0, channel="web", gross_revenue=0.1, total_orders=1, aov=0.1, promo_pct=10.0, total_items_sold=1),
                  day(0, channel="api", gross_revenue=0.2, total_orders=2, aov=0.2, promo_pct=None, total_items_sold=2),
                  day(30, channel="api", gross_revenue=5.0, total_orders=1, aov=5.0, promo_pct=0.1, total_items_sold=1),
                  day(31, channel="api", gross_revenue=9.0, total_orders=1, aov=9.0, promo_pct=0.1, total_items_sold=1))
    got = [tuple(row) for row in analytics.revenue_overview(daily, AS_OF).collect()]
    assert got == [(AS_OF, 0.3, 3, 0.15, 3, 10.0), (AS_OF - timedelta(days=30), 5.0, 1, 5.0, 1, 0.1)]


def test_revenue_by_channel(spark):
    daily = table(spark, "daily_revenue_summary", day(7, channel="b", gross_revenue=1.0, total_orders=1, aov=1.0),
                  day(0, channel="b", gross_revenue=1.0, total_orders=1, aov=1.01),
                  day(0, channel="a", gross_revenue=2.0, total_orders=1, aov=2.0),
                  day(8, channel="c", gross_revenue=9.0, total_orders=1, aov=2.0))
    assert [tuple(row) for row in analytics.revenue_by_channel(daily, AS_OF).collect()] == [
        ("a", 1, 2.0, 2.0), ("b", 2, 2.0, 1.01)]


def test_week_over_week_skips_missing_weeks_and_zero(spark):
    monday = date(2024, 11, 4)
    rows_in = [{"order_date": monday, "gross_revenue": 50.0}, {"order_date": monday + timedelta(days=6), "gross_revenue": 1.0},
               {"order_date": monday - timedelta(days=14), "gross_revenue": 0.0},
               {"order_date": monday - timedelta(days=21), "gross_revenue": 40.0}]
    got = [tuple(row) for row in analytics.wow_growth(table(spark, "daily_revenue_summary", *rows_in), AS_OF).collect()]
    assert got == [(monday, 51.0, 0.0, None), (monday - timedelta(days=14), 0.0, 40.0, -100.0),
                   (monday - timedelta(days=21), 40.0, None, None)]


def test_products(spark):
    performance = table(spark, "product_performance", *[
        {"product_id": f"p{number:02}", "revenue": 100.0 - number // 2, "rank_by_revenue": 1 + number // 2 * 2,
         "margin_pct": 33.35, "rating": 4.25, "is_low_stock": number % 2 == 0 if number else None} for number in range(60)])
    top = analytics.top_products(performance).collect()
    assert [row["product_id"] for row in top] == [f"p{number:02}" for number in range(10)]
    assert (top[0]["margin_pct"], top[0]["rating"]) == (33.4, 4.3)
    low = analytics.low_stock_alert(performance).collect()
    assert [row["product_id"] for row in low] == [f"p{number:02}" for number in range(2, 42, 2)]


def test_customers(spark):
    rfm = table(spark, "customer_rfm",
                {"customer_id": "b", "rfm_segment": "Champions", "monetary": 10.01, "recency_days": 1, "frequency": 1},
                {"customer_id": "a", "rfm_segment": "Champions", "monetary": 10.01, "recency_days": 2, "frequency": 2},
                {"customer_id": "c", "rfm_segment": "Lost", "monetary": 99.0, "recency_days": 3, "frequency": 4})
    assert [tuple(row) for row in analytics.segment_distribution(rfm).collect()] == [
        ("Lost", 1, 99.0, 3.0, 4.0, 99.0), ("Champions", 2, 10.01, 2.0, 1.5, 20.02)]
    assert [row["customer_id"] for row in analytics.champions(rfm).collect()] == ["a", "b"]


def test_countries(spark):
    geo = table(spark, "geo_revenue", *[
        day(number % 2 * 30, country=f"c{number // 2:02}", revenue=1.0, orders=1, unique_customers=1, aov=1.0)
        for number in range(40)], day(31, country="old", revenue=99.0, orders=1, unique_customers=1, aov=1.0),
        day(0, country=None, revenue=5.0, orders=1, unique_customers=1, aov=5.0))
    got = analytics.top_countries(geo, AS_OF).collect()
    assert [row["country"] for row in got] == [None] + [f"c{number:02}" for number in range(14)]
    assert got[1]["unique_customers"] == 2


def test_funnel_share(spark):
    funnel = table(spark, "order_status_funnel", day(0, status="a", order_count=1, total_value=1.0),
                   day(7, status="a", order_count=1, total_value=1.5), day(3, status="b", order_count=1, total_value=0.1),
                   day(8, status="b", order_count=50, total_value=1.0))
    assert [tuple(row) for row in analytics.funnel_share(funnel, AS_OF).collect()] == [
        ("a", 2, 2.5, 66.7), ("b", 1, 0.1, 33.3)]


def test_silver_quality(spark):
    orders = spark.createDataFrame([("a", 1.0, "2024-11-03"), ("a", 2.0, "2024-11-03"), ("b", 9.0, "2024-11-02")],
                                   "order_id string, total double, date_partition string")
    assert rows(analytics.silver_quality(orders, AS_OF)) == [("2024-11-03", 2, 1, 0, 1.0, 2.0)]


def test_latest_daily_revenue(spark):
    daily = table(spark, "daily_revenue_summary", *[day(number, channel="web") for number in range(40)])
    got = dicts(analytics.latest_daily_revenue(daily, 3))
    assert [row["order_date"] for row in got] == [AS_OF - timedelta(days=number) for number in range(3)]
    assert set(got[0]) == set(schemas.GOLD_TYPES["daily_revenue_summary"])


def test_old_partitions_are_not_read(spark, root):
    daily = table(spark, "daily_revenue_summary", *[day(number, channel="web", gross_revenue=1.0, total_orders=1)
                                                    for number in range(40)])
    daily.write.partitionBy("order_date").parquet(f"{root}/daily")
    stored = spark.read.schema(schemas.ddl(schemas.GOLD_TYPES["daily_revenue_summary"])).parquet(f"{root}/daily")
    text = analytics.revenue_by_channel(stored, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in text
    assert by(analytics.revenue_by_channel(stored, AS_OF), "channel")["web"]["orders"] == 8
