"""Business tables by order date after changes, against a full rebuild."""

from datetime import date, datetime

import pytest

from helpers import raw, rows
from ledgerloom import schemas
from ledgerloom.plans import batch, incremental
from ledgerloom.sources import bronze, tables

CLOCK = datetime(2024, 12, 1)
D1, D2, D3 = date(2024, 11, 1), date(2024, 11, 2), date(2024, 11, 3)


def land(spark, root, day, **changes):
    for table in schemas.ENTITIES:
        bronze.land_csv(raw(spark, table, *changes.get(table, [])), root, table, day)


def gold_rows(spark, root):
    return {table: rows(tables.read_gold(spark, root, table), *[name for name in schemas.GOLD_TYPES[table]
                                                              if name not in ("updated_at", "date_partition")])
            for table in incremental.DATED}


def order(key, day, customer="c1", **changes):
    return {"order_id": key, "customer_id": customer, "created_at": f"2024-10-{day:02d} 10:00:00", **changes}


def item(key, of, **changes):
    return {"item_id": key, "order_id": of, **changes}


@pytest.fixture
def lake(spark, root):
    """Two days in the clean and business layers."""
    land(spark, root, D1, orders=[order("a", 1), order("b", 2), order("c", 3, "c2"), order("d", 4), order("e", 5)],
         order_items=[item(f"i{key}", key) for key in "abcde"], customers=[{}, {"customer_id": "c2", "country": "DE"}], products=[{}])
    land(spark, root, D2, orders=[order("f", 6)], order_items=[item("if", "f")])
    batch.run_range(spark, root, root, D1, D2, CLOCK)
    batch.run_gold(spark, root, root, D2, CLOCK)
    return root


def refreshed(spark, root, day, expected_dates):
    """The dates that were rebuilt are the expected ones, and all dates equal a full rebuild."""
    incremental.refresh(spark, root, root, [day], lambda: batch.run_silver(spark, root, root, day, CLOCK), D3, CLOCK)
    written = {str(row[0]) for table in incremental.DATED for row in tables.read_gold(spark, root, table)
               .filter(f"date_partition = '{D3}'").select("order_date").distinct().collect()}
    assert written == expected_dates
    batch.run_gold(spark, root, f"{root}/full", D3, CLOCK)
    got = gold_rows(spark, root)
    assert got == gold_rows(spark, f"{root}/full")
    return got


def test_late_versions_and_a_moved_date(spark, lake):
    land(spark, lake, D3, orders=[order("a", 9, updated_at="2024-12-01"), order("b", 2, status="cancelled", updated_at="2024-12-01"),
                                  order("g", 7), order("h", 7, created_at=None)],
         order_items=[item("ig", "g"), item("ih", "h")])
    got = refreshed(spark, lake, D3, {"2024-10-02", "2024-10-07", "2024-10-09", "None"})
    funnel = [row[0] for row in got["order_status_funnel"]]
    assert date(2024, 10, 1) not in funnel and date(2024, 10, 9) in funnel  # the date that "a" left has no rows any more


def test_items_that_move_and_customers_that_change(spark, lake):
    land(spark, lake, D3, order_items=[item("id", "e", quantity="7")], customers=[{"customer_id": "c2", "country": "FR"}])
    refreshed(spark, lake, D3, {"2024-10-03", "2024-10-04", "2024-10-05"})


def test_a_repeated_day_that_lost_rows(spark, lake):
    land(spark, lake, D2, orders=[order("k", 8)])
    got = refreshed(spark, lake, D2, {"2024-10-08"})
    assert date(2024, 10, 6) not in [row[0] for row in got["order_status_funnel"]]


def test_nothing_changed_and_nothing_there(spark, lake, tmp_path):
    before = gold_rows(spark, lake)
    counts = incremental.rebuild_dates(spark, lake, lake, spark.createDataFrame([], "order_date date"), D3, CLOCK)
    assert {row["row_count"] for row in counts.collect()} == {0} and gold_rows(spark, lake) == before
    assert incremental.affected_dates(spark, str(tmp_path / "none"), [D1]).count() == 0
