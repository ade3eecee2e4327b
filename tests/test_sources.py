import os
import time
from datetime import date

import pytest

from helpers import by, raw, rows
from ledgerloom.sources import bronze, manifest, staging
from ledgerloom.schemas import raw_ddl
from pyspark.sql import functions as F

DAY = date(2024, 11, 1)


def put(root, key, text="x"):
    path = os.path.join(root, key)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as file:
        file.write(text)


def test_csv_is_text_and_empty_is_null(spark, root):
    put(root, "a.csv", 'k,n,s\n1,007, x \n2,,""\n')
    got = bronze.read_csv(spark, f"{root}/a.csv")
    assert rows(got) == [("1", "007", " x "), ("2", None, None)]


def test_schema_is_honoured_and_the_header_checked(spark, root):
    put(root, "a.csv", "k,n\n1,2\n")
    put(root, "b.csv", "n,k\n1,2\n")
    assert rows(bronze.read_csv(spark, f"{root}/a.csv", "k int, n int")) == [(1, 2)]
    with pytest.raises(Exception, match="header"):
        bronze.read_csv(spark, f"{root}/b.csv", "k int, n int").collect()


def test_landing_keeps_the_rows(spark, root):
    data = raw(spark, "orders", {"status": "  padded ", "promo_code": 'with "quotes", comma'}, {"order_id": None})
    bronze.land_csv(data, root, "orders", DAY)
    assert os.path.isdir(f"{root}/bronze/orders/dt=2024/11/01")
    assert rows(bronze.read_day(spark, root, "orders", DAY)) == rows(data)


def test_all_formats_read_alike(spark, root):
    data = raw(spark, "products", {}, {"product_id": "p2", "stock_qty": None})
    data.write.json(f"{root}/bronze/products/dt=2024/11/01")
    assert rows(bronze.read_day(spark, root, "products", DAY, "json")) == rows(data)
    data.selectExpr("*", "1 extra").withColumn("price", data["price"].cast("double")).write.parquet(
        f"{root}/bronze/products/dt=2024/11/02")
    got = bronze.read_day(spark, root, "products", "2024-11-02", "parquet")
    assert got.schema["price"].dataType.simpleString() == "string" and got.count() == 2
    with pytest.raises(ValueError, match="unsupported format"):
        bronze.read_day(spark, root, "products", DAY, "xml")


def test_days_in_both_layouts(spark, root):
    bronze.land_csv(raw(spark, "orders", {"order_id": "a"}), root, "orders", "2024-11-01")
    later = raw(spark, "orders", {"order_id": "b"}, {"order_id": "c"}).selectExpr(
        "*", "case order_id when 'b' then '2024-11-02' else '2024-11-05' end as day")
    bronze.land_csv_days(later, root, "orders", "day")
    got = bronze.read_days(spark, root, "orders", DAY, date(2024, 11, 4))
    assert rows(got, "order_id", "date_partition") == [("a", "2024-11-01"), ("b", "2024-11-02")]
    assert bronze.read_all_days(spark, root, "orders").count() == 3


def test_file_order(spark, root):
    put(root, "bronze/orders/dt=2024/11/01/b.csv", ",".join(raw(spark, "orders", {}).columns) + "\nb1\nb2\n")
    put(root, "bronze/orders/dt=2024/11/01/a.csv", ",".join(raw(spark, "orders", {}).columns) + "\na1\na2\n")
    got = bronze.read_all_days(spark, root, "orders").orderBy(*bronze.FILE_ORDER).select("order_id").collect()
    assert [row[0] for row in got] == ["a1", "a2", "b1", "b2"]


def test_files_of_other_kinds_are_left_alone(spark, root):
    bronze.land_csv(raw(spark, "orders", {}, {"order_id": "o2"}), root, "orders", "2024-11-01")
    put(root, "bronze/orders/dt=2024/11/01/notes.txt", "a,b\n1,2\n")
    put(root, "bronze/orders/dt=2024/11/01/more.json", '{"order_id": "o3"}\n')
    assert bronze.read_day(spark, root, "orders", "2024-11-01").count() == 2
    assert bronze.read_day(spark, root, "orders", "2024-11-01", "any").count() == 3


def test_json_files_hold_a_number_of_rows(spark, root):
    bronze.land_json(spark.range(1200).coalesce(1), f"{root}/events", rows_per_file=500)
    assert len([name for name in os.listdir(f"{root}/events") if name.startswith("part")]) == 3


def test_manifest(spark, root):
    for key in ("bronze/orders/dt=2024/11/01/may.csv", "bronze/returns/dt=2024/11/01/june.csv",
                "inbox/list.csv", "bronze/products/dt=2024/02/20/catalogue.json",
                "bronze/orders/dt=2024/11/01/notes.txt", "bronze/orders/dt=2024-11-02/a b+c.parquet",
                "bronze/orders/dt=2024/11/01/noext"):
        put(root, key, "x" * 3000)
    got = by(manifest.file_manifest(spark, root), "filename")
    found = {key: (row["table_name"], row["ingest_date"], row["ext"], row["status"]) for key, row in got.items()}
    assert found == {
        "may.csv": ("orders", "2024-11-01", ".csv", "accepted"),
        "june.csv": ("returns", "2024-11-01", ".csv", "unknown table"),
        None: (None, None, None, "unrecognised key"),
        "catalogue.json": ("products", "2024-02-20", ".json", "accepted"),
        "notes.txt": ("orders", "2024-11-01", ".txt", "unsupported extension"),
        "a b+c.parquet": ("orders", "2024-11-02", ".parquet", "accepted"),
        "noext": ("orders", "2024-11-01", "", "unsupported extension")}
    assert (got["may.csv"]["size_bytes"], got["may.csv"]["size_mb"]) == (3000, 0.003)
    assert got["may.csv"]["last_modified"] is not None
    summary = manifest.ingest_summary(manifest.file_manifest(spark, root))
    assert rows(summary.filter("table_name = 'orders'")) == [
        ("orders", "accepted", 2, 6000), ("orders", "unsupported extension", 2, 6000)]
    assert rows(manifest.ingest_totals(manifest.file_manifest(spark, root))) == [(7, 3, 4)]


def test_manifest_reads_no_content(spark, root):
    put(root, "bronze/orders/dt=2024/11/01/orders.csv")
    plan = manifest.file_manifest(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema: ")[1]


def test_event_keys_are_decoded(spark):
    events = spark.createDataFrame([("bronze%2Forders/dt%3D2024/11/01/my+orders.csv",), ("bad%zz",)], "key string")
    got = by(manifest.classify_events(events, "key"), "status")
    assert got["accepted"]["filename"] == "my orders.csv" and "unrecognised key" in got


def test_staged_rows_come_back(spark):
    df = spark.range(10).selectExpr("id", "cast(id as string) s")
    staged = staging.stage(df, "test")
    assert staged.dtypes == df.dtypes and rows(staged) == rows(df)
    assert staged.inputFiles()[0].split("/test-")[0].removeprefix("file://").rstrip("/") in staging.scratch_root(spark)


def test_raw_schema_is_all_text():
    assert raw_ddl("order_items").count(" string") == 8


def test_header_names_the_columns(spark, root):
    put(root, "bronze/order_items/dt=2024/11/01/a.csv",
        "order_id,item_id,note,product_id,quantity,unit_price,discount,line_total,created_at\no1,i1,hi,p1,1,1,0,1,\n")
    got = bronze.read_day(spark, root, "order_items", DAY)
    assert rows(got, "item_id", "order_id", "note", "created_at") == [("i1", "o1", "hi", None)]


def test_files_are_read_by_their_own_headers(spark, root):
    put(root, "bronze/products/dt=2024/11/01/a.csv", "product_id,name,price\np1,one,1\np2,two,2\n")
    put(root, "bronze/products/dt=2024/11/01/b.csv", '\ufeffprice,"product_id",name\n3,p3,three\n')
    put(root, "bronze/products/dt=2024/11/02/c.csv", "name,colour,price,product_id,colour,\n" + "".join(f"n{i},red,{i},q{i},x,y\n" for i in range(3000)))
    put(root, "bronze/products/dt=2024/11/02/d.csv", "")
    put(root, "bronze/products/dt=2024/11/02/e.csv", "name,price,product_id\n")
    got = bronze.read_days(spark, root, "products", DAY, date(2024, 11, 2))
    assert rows(got.filter("product_id like 'p%'"), "product_id", "name", "price", "colour", "supplier", "date_partition") == [
        ("p1", "one", "1", None, None, "2024-11-01"), ("p2", "two", "2", None, None, "2024-11-01"),
        ("p3", "three", "3", None, None, "2024-11-01")]
    later = got.filter("date_partition = '2024-11-02'")
    assert later.count() == 3000 and later.filter("name = concat('n', price) and product_id = concat('q', price) and colour = 'red'").count() == 3000
    found = bronze.headers(spark, f"{root}/bronze/products", recursive=True)
    assert "c.csv" in str(found.collect())
    # single days give the same rows, and the order of files is known for them too
    single = [bronze.read_day(spark, root, "products", day) for day in (DAY, "2024-11-02")]
    assert sum(day.count() for day in single) == got.count()
    assert rows(bronze.read_all_days(spark, root, "products").filter("product_id = 'p3'"), "price", "_block") == [("3", 0)]
    put(root, "bronze/orders/dt=2024/11/01/empty.csv", "")
    assert bronze.read_days(spark, root, "orders", DAY, DAY).count() == 0


def test_large_files_give_one_header_each(spark, root):
    put(root, "bronze/orders/dt=2024/11/01/a.csv", "order_id,total\n" + "".join(f"o{i},{i}\n" for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000b")
    try:
        groups = bronze._header_groups(spark, f"{root}/bronze/orders/dt=2024/11/01", False, "*.csv")
        assert [(header, len(files)) for header, files in groups] == [(["order_id", "total"], 1)]
        got = bronze.read_day(spark, root, "orders", DAY)
        assert tuple(got.selectExpr("count(*)", "sum(total)", "count(customer_id)").first()) == (20000, 199990000.0, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_doubled_quotes_and_backslashes(spark, root):
    put(root, "a.csv", 'k,n,s\n1,"thing ""x"", y",z\n2,"ends with \\",v\n')
    assert rows(bronze.read_csv(spark, f"{root}/a.csv")) == [("1", 'thing "x", y', "z"), ("2", "ends with \\", "v")]


def test_each_file_is_read_by_its_extension(spark, root):
    data = raw(spark, "products", {"product_id": "a"}, {"product_id": "b"}, {"product_id": "c"})
    target = f"{root}/bronze/products/dt=2024/11/01"
    bronze.write_text(data.filter("product_id = 'a'")).mode("append").csv(target)
    data.filter("product_id = 'b'").write.mode("append").json(target)
    data.filter("product_id = 'c'").write.mode("append").parquet(target)
    put(root, "bronze/products/dt=2024/11/01/notes.txt")
    assert rows(bronze.read_day(spark, root, "products", DAY, "any").drop("_path")) == rows(data)
    got = bronze.read_days(spark, root, "products", DAY, date(2024, 11, 2), "any")
    assert rows(got, "product_id", "date_partition") == [(key, "2024-11-01") for key in "abc"]
    with pytest.raises(ValueError, match="no file"):
        put(root, "bronze/orders/dt=2024/11/01/notes.txt")
        bronze.read_day(spark, root, "orders", DAY, "any")


def test_landing_many_days_moves_no_row_between_tasks(spark, root):
    # each task writes its own file of a date, so the rows of a date held by two tasks stay in two files
    orders = raw(spark, "orders", {"order_id": "a"}, {"order_id": "b"}).repartition(2).withColumn("day", F.lit("2024-11-02"))
    assert orders.rdd.glom().map(len).collect() == [1, 1]
    bronze.land_csv_days(orders, root, "orders", "day")
    assert len([name for name in os.listdir(f"{root}/bronze/orders/dt=2024-11-02") if name.endswith(".csv")]) == 2
    got = bronze.read_days(spark, root, "orders", date(2024, 11, 2), date(2024, 11, 2))
    assert rows(got, "order_id", "date_partition") == [("a", "2024-11-02"), ("b", "2024-11-02")]


def test_a_staged_table_leaves_no_shuffle_files(spark, root):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {name for name in (files.apply(at).getName() for at in range(files.size())) if name.startswith("shuffle_")}
    before = shuffles()
    counts = spark.range(5000).repartition(4).groupBy((F.col("id") % 997).alias("k")).count()
    staging.stage(counts, "counts", root)
    until = time.time() + 20
    while time.time() < until and shuffles() - before:
        time.sleep(0.2)
    assert not shuffles() - before
    assert staging.folder_exists(spark, f"{root}/counts")
