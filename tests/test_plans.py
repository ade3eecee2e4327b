import os
from datetime import date, datetime, timedelta

import pytest

from helpers import plan, raw, rows
from ledgerloom import schemas
from ledgerloom.operators.clean import cleaned, quarantine, silver
from ledgerloom.plans import batch
from ledgerloom.sources import bronze, tables
from ledgerloom.testbed import queries
from pyspark.sql import functions as F

CLOCK = datetime(2024, 12, 1)
D1, D2, D3 = date(2024, 11, 1), date(2024, 11, 2), date(2024, 11, 3)


def land(spark, root, day, **changes):
    for table in schemas.ENTITIES:
        bronze.land_csv(raw(spark, table, *changes.get(table, [{}])), root, table, day)


def silver_rows(spark, root, table="orders"):
    return rows(tables.read_silver(spark, root, table))


def test_run_silver_writes_one_date_and_can_be_repeated(spark, root):
    land(spark, root, D1, orders=[{}, {"order_id": "o2", "total": "-1"}])
    land(spark, root, D2, orders=[{"order_id": "o3"}])
    first = batch.run_silver(spark, root, root, D1, CLOCK)
    assert rows(first, "layer", "table_name", "row_count") == [
        ("rejected", "customers", 0), ("rejected", "order_items", 0), ("rejected", "orders", 1), ("rejected", "products", 0),
        ("silver", "customers", 1), ("silver", "order_items", 1), ("silver", "orders", 1), ("silver", "products", 1)]
    before = silver_rows(spark, root)
    batch.run_silver(spark, root, root, D2, CLOCK)
    assert [row[0] for row in silver_rows(spark, root)] == ["o1", "o3"]
    batch.run_silver(spark, root, root, D1, CLOCK)
    assert [row for row in silver_rows(spark, root) if row[-1] == "2024-11-01"] == before
    assert tables.read_rejected(spark, root, "orders").select("order_id", "reject_reason", "raw.total", "raw.currency").collect() == [
        ("o2", "negative total", "-1", "usd ")]


@pytest.mark.parametrize("table", schemas.ENTITIES)
def test_clean_and_rejected_rows_come_from_one_scan(spark, root, table):
    changes = [{}, {schemas.KEYS[table]: None}, {schemas.KEYS[table]: None}, {}]
    data = raw(spark, table, *changes)
    bronze.land_csv(data, root, table, D1)
    both = cleaned(table, bronze.read_day(spark, root, table, D1), str(D1), CLOCK)
    assert plan(both).split("Initial Plan")[0].count("FileScan") == 1
    assert rows(both.filter("kind = 'clean'"), *schemas.SILVER_TYPES[table]) == rows(silver(table, data, str(D1), CLOCK))
    left_out = both.filter("kind = 'rejected'")
    assert left_out.count() == 2  # alike in every column, both kept
    names = [*schemas.ENTITY_TYPES[table], *schemas.DERIVED_TYPES[table], "reject_reason", "date_partition"]
    assert rows(left_out, *names) == rows(quarantine(table, data, str(D1)), *names)
    assert left_out.select("raw.*").distinct().count() == 1


def test_rejected_rows_keep_the_text_that_did_not_parse(spark, root):
    land(spark, root, D1, orders=[{"total": "12,50"}, {"total": "n/a", "order_id": "o2", "updated_at": "soon"}])
    batch.run_silver(spark, root, root, D1, CLOCK)
    assert rows(tables.read_rejected(spark, root, "orders"), "total", "raw.total", "raw.updated_at") == [
        (None, "12,50", "2024-11-02 10:30:00"), (None, "n/a", "soon")]


def test_a_date_left_without_rows_is_emptied(spark, root):
    land(spark, root, D1)
    batch.run_silver(spark, root, root, D1, CLOCK)
    land(spark, root, D1, orders=[{"total": "bad"}])
    batch.run_silver(spark, root, root, D1, CLOCK)
    land(spark, root, D2)
    batch.run_silver(spark, root, root, D2, CLOCK)
    assert {row[-1] for row in silver_rows(spark, root)} == {"2024-11-02"}


def test_range_equals_single_days(spark, root):
    days = [D1, D2, D3]
    for number, day in enumerate(days):
        land(spark, root, day, orders=[{"status": f"s{number}"}, {"order_id": f"x{number}", "customer_id": None},
                                       {"status": "older", "updated_at": "2024-01-01"}])
    batch.run_range(spark, root, f"{root}/range", D1, D3, CLOCK)
    for day in days:
        batch.run_silver(spark, root, f"{root}/daily", day, CLOCK)
    for table in schemas.ENTITIES:
        assert silver_rows(spark, f"{root}/range", table) == silver_rows(spark, f"{root}/daily", table)
    rejected = rows(tables.read_rejected(spark, f"{root}/range", "orders"))
    assert rejected == rows(tables.read_rejected(spark, f"{root}/daily", "orders")) and len(rejected) == 3
    batch.run_range(spark, root, f"{root}/range", D2, D3, CLOCK)
    assert silver_rows(spark, f"{root}/range") == silver_rows(spark, f"{root}/daily")


def test_range_limits(spark, root):
    with pytest.raises(ValueError, match="exceeds the limit of 30"):
        batch.run_range(spark, root, root, D1, D1 + timedelta(days=30))
    with pytest.raises(ValueError, match="ends before"):
        batch.run_range(spark, root, root, D2, D1)
    assert batch.yesterday(datetime(2024, 3, 1, 0, 30)) == date(2024, 2, 29)


def test_run_gold_takes_the_latest_version_over_all_dates(spark, root):
    land(spark, root, D1, orders=[{"status": "pending"}, {"order_id": "o2", "status": "shipped"}])
    land(spark, root, D2, orders=[{"status": "delivered", "updated_at": "2024-11-09"}], customers=[{"country": "de"}])
    for day in (D1, D2):
        batch.run_silver(spark, root, root, day, CLOCK)
    counts = batch.run_gold(spark, root, root, D2, CLOCK)
    assert {row["table_name"]: row["row_count"] for row in counts.collect()} == {
        "daily_revenue_summary": 1, "customer_rfm": 1, "product_performance": 1, "geo_revenue": 1,
        "order_status_funnel": 2}
    assert rows(tables.read_gold(spark, root, "order_status_funnel"), "status", "order_count") == [
        ("delivered", 1), ("shipped", 1)]
    assert rows(tables.read_gold(spark, root, "geo_revenue"), "country", "orders") == [("DE", 2)]
    assert rows(tables.read_gold(spark, root, "daily_revenue_summary"), "total_items_sold") == [(1,)]
    before = {name: rows(tables.read_gold(spark, root, name)) for name in schemas.GOLD_TYPES}
    batch.run_gold(spark, root, root, D2, CLOCK)
    assert before == {name: rows(tables.read_gold(spark, root, name)) for name in schemas.GOLD_TYPES}


def test_null_partitions_and_catalog(spark, root):
    land(spark, root, D1, orders=[{"created_at": "never"}, {"order_id": "o2"}],
         order_items=[{}, {"item_id": "i2", "product_id": "not listed"}])
    batch.run_silver(spark, root, root, D1, CLOCK)
    batch.run_gold(spark, root, root, D1, CLOCK)
    assert rows(tables.read_gold(spark, root, "order_status_funnel"), "order_date", "order_count") == [
        (None, 1), (D1, 1)]
    assert rows(tables.read_gold(spark, root, "product_performance"), "product_id", "category") == [
        ("not listed", None), ("p1", "Home & Kitchen")]
    tables.create_catalog(spark, root, root, "test_silver", "test_gold")
    tables.create_catalog(spark, root, root, "test_silver", "test_gold")
    for name, types in schemas.GOLD_TYPES.items():
        stored = spark.table(f"test_gold.{name}")
        assert {f.name: f.dataType.simpleString() for f in stored.schema} == types
        assert rows(stored.select(*types)) == rows(tables.read_gold(spark, root, name))
    assert rows(spark.sql("select order_id, date_partition from test_silver.orders")) == [
        ("o1", "2024-11-01"), ("o2", "2024-11-01")]


def test_flat_run(spark, root):
    land(spark, root, D1, orders=[{}, {}, {"order_id": "o2", "status": "cancelled"}])
    land(spark, root, D2, orders=[{"total": "-1.00"}], customers=[{"country": "de"}])
    for day in (D1, D2):
        batch.run_flat_clean(spark, root, root, day)
    counts = batch.run_flat_gold(spark, root, root, D2)
    assert {row["table_name"]: row["row_count"] for row in counts.collect()} == {
        "daily_revenue": 1, "geo_revenue": 1, "order_funnel": 2, "orders_processed": 3}
    stored = bronze.read_csv(spark, f"{root}/flat_gold/geo_revenue/dt=2024-11-02")
    assert rows(stored) == [("DE", "2", "15.99")]
    got = {name: rows(df) for name, df in batch.run_report(spark, root, D2).items()}
    assert got == {"channels": [("web", 2, 15.99)], "countries": [("DE", 2, 15.99)],
                   "funnel": [("cancelled", 1, 33.3, "#" * 16), ("shipped", 2, 66.7, "#" * 33)],
                   "summary": [(2, 15.99, 8.0, 1, 1)]}


def test_flat_run_without_rows_writes_nothing(spark, root):
    land(spark, root, D1, orders=[{"order_id": None}])
    batch.run_flat_clean(spark, root, root, D1)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        bronze.read_csv(spark, f"{root}/flat_silver/orders/dt=2024-11-01")


def test_totals_agree_between_tables(spark):
    from ledgerloom.testbed import queries
    sf = "/root/testdata/sf0.001"
    run = queries.registered()

    def total(name, column):
        return run[name](spark, sf).agg(F.sum(F.col(column).cast("decimal(18,2)"))).first()[0]

    assert total("flat_daily_revenue", "gross_revenue") == total("flat_geo_revenue", "revenue")
    assert total("gold_order_funnel", "order_count") == run["silver_orders"](spark, sf).count()
    assert total("gold_daily_revenue", "gross_revenue") == total("gold_product_performance", "revenue")


def test_cleaned_rows_of_many_days_are_written_by_the_tasks_that_keep_them(spark, root):
    # no shuffle after one row per key is kept: a date's rows come in the files of the tasks that kept them
    keys = [{"order_id": f"o{at}"} for at in range(40)]
    days = raw(spark, "orders", *keys).withColumn("date_partition", F.when(F.col("order_id") < "o2", str(D1)).otherwise(str(D2)))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # so that the tasks that keep the rows stay apart
    try:
        counts = tables.write_cleaned(cleaned("orders", days, None, CLOCK), root, "orders", [D1, D2])
    finally:
        spark.conf.set(setting, "true")
    assert counts == {"clean": 40, "rejected": 0}
    files = [name for name in os.listdir(f"{root}/silver/orders/kind=clean/date_partition={D2}") if name.endswith(".parquet")]
    assert len(files) > 1
    assert rows(tables.read_silver(spark, root, "orders").groupBy("date_partition").count()) == [(str(D1), 12), (str(D2), 28)]


@pytest.mark.parametrize(("name", "left"), [("run_summary", []), ("gold_incremental", ["dt=2001", "dt=2001-08-01"])])
def test_raw_text_goes_once_it_is_cleaned(spark, root, monkeypatch, name, left):
    """Only the steps before and after cleaning run here; the queries are compared whole elsewhere."""
    counts = tables.run_summary(spark, "x", {"orders": 1})
    monkeypatch.setattr(queries, "fresh_folder", lambda *_: f"{root}/{name}")
    for module, step in ((batch, "run_silver"), (batch, "run_gold"), (batch, "run_range"), (queries.incremental, "rebuild_dates"),
                         (queries.incremental, "refresh"), (tables, "read_silver"), (tables, "read_gold")):
        monkeypatch.setattr(module, step, lambda *_: counts)
    assert queries.registered()[name](spark, "/root/testdata/sf0.001").count() > 0
    raw_orders = f"{root}/{name}/bronze/orders"
    found = sorted(folder for folder in os.listdir(raw_orders) if folder.startswith("dt=")) if os.path.isdir(raw_orders) else []
    assert found == left
