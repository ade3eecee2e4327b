"""Partitions in the catalog follow what was written."""

from datetime import date

from helpers import raw, rows
from ledgerloom import schemas
from ledgerloom.operators.clean import cleaned
from ledgerloom.sources import tables


def daily(spark, table, *values):
    """Rows of a business table that hold nothing but their partition."""
    types, partition = schemas.GOLD_TYPES[table], schemas.GOLD_LAYOUT[table][0]
    ddl = schemas.ddl(types)
    return spark.createDataFrame([tuple(value if name == partition else None for name in types) for value in values], ddl)


def folders(frame):
    return {path.rsplit("/", 2)[-2] for path in frame.inputFiles()}


def test_replaced_tables_have_the_partitions_just_written(spark, root):
    table, days = "order_status_funnel", [date(2024, 1, day) for day in range(1, 31)]
    tables.create_database(spark, "published", "Test", f"{root}/gold")
    assert tables.publish_gold(daily(spark, table, *days, None), root, table, "published") == 31
    known = tables.registered_partitions(spark, "published", table)
    assert known == {*map(str, days), tables.NO_VALUE}
    asked = spark.table(f"published.{table}").where("order_date between date '2024-01-05' and date '2024-01-06'")
    assert folders(asked) == {"order_date=2024-01-05", "order_date=2024-01-06"} and asked.count() == 2
    assert spark.table(f"published.{table}").where("order_date is null").count() == 1
    assert tables.publish_gold(daily(spark, table, *days[:2], days[0]), root, table, "published") == 3
    assert tables.registered_partitions(spark, "published", table) == {"2024-01-01", "2024-01-02"}
    assert rows(spark.table(f"published.{table}"), "order_date") == [(days[0],)] * 2 + [(days[1],)]
    assert tables.publish_gold(daily(spark, table), root, table, "published") == 0
    assert tables.registered_partitions(spark, "published", table) == set()


def test_categories_of_any_text(spark, root, monkeypatch):
    monkeypatch.setattr(tables, "PARTITIONS_AT_ONCE", 2)
    table, names = "product_performance", ["Home & Kitchen", "it's", "a/b=c%d", "back\\slash", "é", None]
    tables.create_database(spark, "categories", "Test", f"{root}/gold")
    tables.publish_gold(daily(spark, table, *names), root, table, "categories")
    assert tables.registered_partitions(spark, "categories", table) == {*names[:-1], tables.NO_VALUE}
    for name in names[:-1]:
        found = spark.table(f"categories.{table}").where(spark.table(f"categories.{table}").category == name)
        assert found.count() == 1 and len(folders(found)) == 1
    tables.publish_gold(daily(spark, table, "it's"), root, table, "categories")
    assert tables.registered_partitions(spark, "categories", table) == {"it's"}


def test_dates_without_clean_rows_leave_the_catalog(spark, root):
    tables.create_database(spark, "clean_dates", "Test", f"{root}/silver")

    def publish(*changes):
        frame = cleaned("orders", raw(spark, "orders", *changes), "2024-11-01")
        return tables.publish_cleaned(frame, root, "orders", ["2024-11-01"], "clean_dates")
    assert publish({}, {"order_id": "o2"}, {"order_id": "o3", "total": "-1"}) == {"clean": 2, "rejected": 1}
    assert tables.registered_partitions(spark, "clean_dates", "orders") == {"2024-11-01"}
    assert spark.table("clean_dates.orders").count() == 2
    assert publish({"total": "-1"}) == {"clean": 0, "rejected": 1}
    assert tables.registered_partitions(spark, "clean_dates", "orders") == set()
    assert spark.table("clean_dates.orders").count() == 0
