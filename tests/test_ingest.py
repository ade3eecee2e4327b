"""Cleaning by the stored manifest."""

import os
import time
from datetime import date

import pytest

from helpers import BASE, raw, rows
from ledgerloom import schemas
from ledgerloom.operators import clean
from ledgerloom.plans import ingest
from ledgerloom.sources import bronze, manifest, tables


def orders(spark, root):
    return rows(tables.read_silver(spark, root, "orders"), "order_id", "status", "date_partition")


def put_csv(root, key, table, *changes):
    path = f"{root}/bronze/{table}/{key}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    names = list(schemas.ENTITY_TYPES[table])
    with open(path, "w") as file:
        for row in [dict(zip(names, names, strict=True)), *({**BASE[table], **change} for change in changes)]:
            file.write(",".join(str(row[name] or "") for name in names) + "\n")


def test_only_new_dates_are_read_and_a_second_run_reads_none(spark, root, monkeypatch):
    read = []
    whole = bronze.read_files
    monkeypatch.setattr(bronze, "read_files", lambda spark, files, table: read.extend(files) or whole(spark, files, table))

    def run():
        read.clear()
        counts = {(row["layer"], row[1]): row[2] for row in ingest.ingest(spark, root, root, f"{root}/manifest").collect()}
        return counts, sorted(os.path.basename(file) for file in read)

    put_csv(root, "dt=2024/11/01/a [1].csv", "orders", {}, {"order_id": "o2", "total": "-1"})
    put_csv(root, "dt=2024-11-02/b.csv", "orders", {"order_id": "o3"})
    put_csv(root, "dt=2024/11/01/notes.txt", "orders", {"order_id": "o9"})
    put_csv(root, "dt=2024/11/01/r.csv", "customers", {})
    os.makedirs(f"{root}/bronze/returns/dt=2024/11/01")
    with open(f"{root}/bronze/returns/dt=2024/11/01/x.csv", "w") as file:
        file.write("order_id\no9\n")
    counts, files = run()
    assert files == ["a [1].csv", "b.csv", "r.csv"]
    assert counts == {("silver", "orders"): 2, ("rejected", "orders"): 1, ("silver", "customers"): 1, ("rejected", "customers"): 0}
    first = orders(spark, root)
    assert [row[::2] for row in first] == [("o1", "2024-11-01"), ("o3", "2024-11-02")]
    assert run() == ({}, []) and orders(spark, root) == first
    recorded = rows(manifest.stored(spark, f"{root}/manifest"), "filename", "table_name", "ingest_date")
    assert recorded == [("a [1].csv", "orders", "2024-11-01"), ("b.csv", "orders", "2024-11-02"), ("r.csv", "customers", "2024-11-01")]

    # A later file of a date known, of another format: the whole date is read again, the other is not.
    raw(spark, "orders", {"order_id": "o4", "status": "pending"}).coalesce(1).write.json(f"{root}/bronze/orders/dt=2024/11/02")
    _, files = run()
    assert "b.csv" in files and len(files) == 2 and "a [1].csv" not in files
    assert [row[::2] for row in orders(spark, root)] == [("o1", "2024-11-01"), ("o3", "2024-11-02"), ("o4", "2024-11-02")]

    # A changed file is new.
    time.sleep(1.1)
    put_csv(root, "dt=2024/11/01/a [1].csv", "orders", {"order_id": "o5"})
    assert run()[1] == ["a [1].csv"]
    assert [row[0] for row in orders(spark, root)] == ["o3", "o4", "o5"]


def test_a_run_that_breaks_off_is_repeated(spark, root, monkeypatch):
    put_csv(root, "dt=2024/11/01/a.csv", "orders", {})
    with monkeypatch.context() as patch:
        patch.setattr(manifest, "record", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.ingest(spark, root, root, f"{root}/manifest")
    assert ingest.ingest(spark, root, root, f"{root}/manifest").count() == 2
    assert ingest.ingest(spark, root, root, f"{root}/manifest").count() == 0
    assert len(orders(spark, root)) == 1


def test_equals_a_range(spark, root):
    for day, keys in (("2024-11-01", "ab"), ("2024-11-02", "bc")):
        bronze.land_csv(raw(spark, "orders", *({"order_id": key} for key in keys)), root, "orders", day)
    ingest.ingest(spark, root, f"{root}/one", f"{root}/manifest")
    read = bronze.read_days(spark, root, "orders", date(2024, 11, 1), date(2024, 11, 2))
    want = clean.silver("orders", read, None)
    names = [name for name in want.columns if name != "processed_at"]
    assert rows(tables.read_silver(spark, f"{root}/one", "orders"), *names) == rows(want, *names)


def test_no_files(spark, root):
    os.makedirs(f"{root}/bronze")
    assert ingest.ingest(spark, root, root, f"{root}/manifest").count() == 0
