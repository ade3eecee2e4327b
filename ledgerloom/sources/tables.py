"""Readers and writers of the clean and business layers, and their catalog tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators.clean import CLEAN, RAW, REJECT, REJECTED
from ledgerloom.operators.dedup import latest_by_key
from ledgerloom.sources.bronze import read_csv, write_text
from ledgerloom.sources.staging import remove_folder, shuffles_removed

COUNT_TYPES = "layer string, table_name string, row_count bigint"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # folder of rows without a value to partition by
PARTITIONS_AT_ONCE = 500


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame with a row counter that fills while it is written.

    It goes on last: a counter below an exchange is lost when the exchange turns out empty.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_cleaned(df: DataFrame, root: str, table: str, days: Sequence[date | str]) -> dict[str, int]:
    """Make the clean and rejected rows of ``cleaned`` the content of the partitions of ``days``, in one write.

    Gives the rows per kind. Other dates stay. The rows are counted per kind and date while they are written; the folder of a date
    that has none any more is removed, which an overwrite by partition alone would leave behind.
    The tasks that keep one row per key write their rows themselves, one file per kind and date, so no second shuffle follows.
    """
    written = _write_cleaned(df, root, table, days)
    return {kind: sum(rows for (own, _), rows in written.items() if own == kind) for kind in (CLEAN, REJECTED)}


def _write_cleaned(df: DataFrame, root: str, table: str, days: Sequence[date | str]) -> dict[tuple[str, str], int]:
    """Rows written per kind and date."""
    seen, path = Observation(), f"{root}/silver/{table}"
    parts = [(kind, str(day)) for kind in (CLEAN, REJECTED) for day in days]
    counts = [F.count_if((F.col("kind") == kind) & (F.col("date_partition") == day)).alias(f"{kind} {day}") for kind, day in parts]
    with shuffles_removed(df.sparkSession):
        (df.observe(seen, *counts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("kind", "date_partition").parquet(path))
    written = {(kind, day): seen.get[f"{kind} {day}"] for kind, day in parts}
    for (kind, day), count in written.items():
        if count == 0:
            remove_folder(df.sparkSession, f"{path}/kind={kind}/date_partition={day}")
    return written


def silver_path(root: str, table: str, kind: str = CLEAN) -> str:
    return f"{root}/silver/{table}/kind={kind}"


def read_silver(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All rows of a clean table, over all processing dates."""
    return spark.read.schema(schemas.ddl(schemas.SILVER_TYPES[table])).parquet(silver_path(root, table))


def read_rejected(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All rejected rows of a table with their reason and the text they came with."""
    texts = schemas.ddl({name: "string" for name in schemas.ENTITY_TYPES[table]}).replace("` string", "`: string")
    types = {**schemas.SILVER_TYPES[table], REJECT: "string", RAW: f"struct<{texts}>"}
    return spark.read.schema(schemas.ddl(types)).parquet(silver_path(root, table, REJECTED))


def read_current(spark: SparkSession, root: str, table: str, columns: list[str]) -> DataFrame:
    """The valid row per key over all processing dates.

    Orders go by ``updated_at`` and then by processing date, the other tables by processing date.
    """
    key = schemas.KEYS[table]
    newest = ["updated_at", "date_partition"] if table == "orders" else ["date_partition"]
    needed = list(dict.fromkeys([key, *columns, *newest]))
    rows = read_silver(spark, root, table).select(*needed)
    return latest_by_key(rows, [key], newest).select(*columns)


def write_gold(df: DataFrame, root: str, table: str) -> int:
    """Replace a business table; gives the row count.

    A table by order date has few rows per date and many dates, so the dates are spread over a
    fixed number of tasks, each of which sorts and writes its dates as one file per date. The
    other tables may have any number of rows per partition; there a rebalance brings the rows of
    a partition together and splits those that grow too large.
    """
    return _write_gold(df, root, table, "static")[0]


def _write_gold(df: DataFrame, root: str, table: str, overwrite: str) -> tuple[int, set[str]]:
    """Rows written, and the values of the partitions they are in."""
    partition, order = schemas.GOLD_LAYOUT[table]
    if partition == "order_date":
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = df.repartition(tasks, partition).sortWithinPartitions(*order)
    else:
        rows = df.hint("rebalance", partition)
    seen, value = Observation(), F.coalesce(F.nullif(F.col(partition).cast("string"), F.lit("")), F.lit(NO_VALUE))
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(value).alias("values"))  # dates or categories
    with shuffles_removed(df.sparkSession):
        (rows.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
         .partitionBy(partition).parquet(f"{root}/gold/{table}"))
    return seen.get["rows"], set(seen.get["values"])


def replace_gold_dates(df: DataFrame, root: str, table: str, dates: DataFrame) -> int:
    """Make ``df`` the content of the partitions of some order dates of a business table; gives the row count.

    The folder of a date without rows is removed. ``df`` and ``dates`` are read twice, so they should be staged.
    """
    spark = df.sparkSession
    emptied = dates.select("order_date").exceptAll(df.select("order_date").distinct()).select(
        F.coalesce(F.col("order_date").cast("string"), F.lit(NO_VALUE)))
    folders = [row[0] for row in emptied.collect()]  # dates of a calendar
    rows, _ = _write_gold(df, root, table, "dynamic")
    for folder in folders:
        remove_folder(spark, f"{root}/gold/{table}/order_date={folder}")
    return rows


def read_gold(spark: SparkSession, root: str, table: str) -> DataFrame:
    types = schemas.GOLD_TYPES[table]
    return spark.read.schema(schemas.ddl(types)).parquet(f"{root}/gold/{table}").select(*types)


def run_summary(spark: SparkSession, layer: str, counts: dict[str, int]) -> DataFrame:
    """One row per written table."""
    return spark.createDataFrame([(layer, table, rows) for table, rows in counts.items()], COUNT_TYPES)


def write_flat_csv(df: DataFrame, path: str) -> int:
    """CSV with header, null and empty text both as nothing; no rows leave no folder."""
    rows, seen = counted(df)
    write_text(rows).csv(path)
    if seen.get["rows"] == 0:
        remove_folder(df.sparkSession, path)
    return seen.get["rows"]


def read_flat_gold(spark: SparkSession, root: str, table: str, day: date | str) -> DataFrame:
    """A business table of the flat variant as written for one date."""
    return read_csv(spark, f"{root}/flat_gold/{table}/dt={day}", schemas.ddl(schemas.FLAT_GOLD_TYPES[table]))


def create_table(spark: SparkSession, database: str, table: str, types: dict[str, str],
                 partition: str, location: str) -> None:
    """Drop and create an external Parquet table over written files and find its partitions."""
    spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
    declare_table(spark, database, table, types, partition, location)
    spark.sql(f"MSCK REPAIR TABLE {database}.{table}")


def declare_table(spark: SparkSession, database: str, table: str, types: dict[str, str], partition: str, location: str) -> None:
    """An external Parquet table, where there is none of the name, that knows of no partition yet."""
    ordered = {name: kind for name, kind in types.items() if name != partition}
    ordered[partition] = types[partition]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({schemas.ddl(ordered)}) USING parquet "
              f"PARTITIONED BY ({partition}) LOCATION '{location}'")


def registered_partitions(spark: SparkSession, database: str, table: str) -> set[str]:
    """Values of the partitions the catalog knows of; no file is listed."""
    return {unquote(row[0].split("=", 1)[1]) for row in spark.sql(f"SHOW PARTITIONS {database}.{table}").collect()}


def _alter(spark: SparkSession, database: str, table: str, partition: str, values: Iterable[str], action: str, joiner: str) -> None:
    ordered = sorted(values)
    for low in range(0, len(ordered), PARTITIONS_AT_ONCE):
        texts = (value.replace("\\", "\\\\").replace("'", "\\'") for value in ordered[low:low + PARTITIONS_AT_ONCE])
        specs = joiner.join(f"PARTITION ({partition}={'null' if text == NO_VALUE else chr(39) + text + chr(39)})" for text in texts)
        spark.sql(f"ALTER TABLE {database}.{table} {action} {specs}")


def add_partitions(spark: SparkSession, database: str, table: str, partition: str, values: Iterable[str]) -> None:
    """Make the catalog know partitions; those it knows stay."""
    _alter(spark, database, table, partition, values, "ADD IF NOT EXISTS", " ")


def drop_partitions(spark: SparkSession, database: str, table: str, partition: str, values: Iterable[str]) -> None:
    """Make the catalog forget partitions; files of an external table stay."""
    _alter(spark, database, table, partition, values, "DROP IF EXISTS", ", ")


def publish_gold(df: DataFrame, root: str, table: str, database: str) -> int:
    """Replace a business table and its partitions in the catalog by what was written; gives the row count.

    The partitions are known from the write itself, so the table's folder is never listed, however many dates it holds.
    """
    spark, partition = df.sparkSession, schemas.GOLD_LAYOUT[table][0]
    rows, written = _write_gold(df, root, table, "static")
    declare_table(spark, database, table, schemas.GOLD_TYPES[table], partition, f"{root}/gold/{table}")
    known = registered_partitions(spark, database, table)
    drop_partitions(spark, database, table, partition, known - written)
    add_partitions(spark, database, table, partition, written - known)
    spark.catalog.refreshTable(f"{database}.{table}")
    return rows


def publish_cleaned(df: DataFrame, root: str, table: str, days: Sequence[date | str], database: str) -> dict[str, int]:
    """``write_cleaned`` with the dates that have clean rows made known to the catalog and those left without any taken from it."""
    spark, partition = df.sparkSession, "date_partition"
    written = _write_cleaned(df, root, table, days)
    declare_table(spark, database, table, schemas.SILVER_TYPES[table], partition, silver_path(root, table))
    clean = {day: rows for (kind, day), rows in written.items() if kind == CLEAN}
    drop_partitions(spark, database, table, partition, [day for day, rows in clean.items() if not rows])
    add_partitions(spark, database, table, partition, [day for day, rows in clean.items() if rows])
    spark.catalog.refreshTable(f"{database}.{table}")
    return {CLEAN: sum(clean.values()), REJECTED: sum(written.values()) - sum(clean.values())}


def create_database(spark: SparkSession, name: str, comment: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT '{comment}' LOCATION '{location}'")


def create_catalog(spark: SparkSession, silver_root: str, gold_root: str,
                   silver_database: str = "retail_silver", gold_database: str = "retail_gold") -> None:
    """Two databases, the five business tables and the clean orders."""
    create_database(spark, gold_database, "Business tables", f"{gold_root}/gold")
    create_database(spark, silver_database, "Clean tables", f"{silver_root}/silver")
    for table, types in schemas.GOLD_TYPES.items():
        create_table(spark, gold_database, table, types, schemas.GOLD_LAYOUT[table][0],
                     f"{gold_root}/gold/{table}")
    create_table(spark, silver_database, "orders", schemas.SILVER_TYPES["orders"], "date_partition",
                 silver_path(silver_root, "orders"))
