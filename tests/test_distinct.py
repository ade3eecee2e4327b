"""Distinct customers from sketches."""

from ledgerloom.operators import distinct


def test_sketches_add_up_over_days_within_their_error(spark):
    orders = spark.range(60_000).selectExpr(
        "concat('c', pmod(xxhash64(id), 9000)) customer_id", "date_add(date '2024-11-01', cast(id % 20 as int)) order_date",
        "if(id % 7 = 0, 'cancelled', 'shipped') status")
    orders = orders.unionByName(spark.sql("select cast(null as string) customer_id, date '2024-11-01' order_date, 'shipped' status"))
    customers = spark.range(8900).selectExpr("concat('c', id) customer_id", "if(id % 3 = 0, 'US', 'DE') country")
    sketches = distinct.customer_sketches(orders, customers)
    assert sketches.count() == 60  # days times two countries and the unknown
    live = orders.filter("status <> 'cancelled' and customer_id is not null").join(customers, "customer_id", "left")
    for by in ([], ["country"], ["order_date"]):
        want = {
            tuple(row[name] for name in by): row["count"] for row in live.select(*by, "customer_id").distinct().groupBy(*by).count().collect()}
        got = {tuple(row[name] for name in by): row["unique_customers"] for row in distinct.unique_customers(sketches, *by).collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[key] - count) <= 0.05 * count for key, count in want.items())


def test_no_orders(spark):
    none = spark.createDataFrame([], "customer_id string, order_date date, status string")
    sketches = distinct.customer_sketches(none, spark.createDataFrame([], "customer_id string, country string"))
    assert distinct.unique_customers(sketches, "country").count() == 0
