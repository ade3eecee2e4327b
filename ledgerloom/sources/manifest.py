"""What lies in the raw layer: one row per file with its table, date and whether it is accepted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.sources.staging import folder_exists

KEY_PATTERN = r"(?:^|/)bronze/([^/]+)/(?:dt=)?(\d{4})[/-](\d{2})[/-](\d{2})/(.+)$"

# Accepted file extensions.
EXTENSIONS = [".csv", ".json", ".parquet"]

ACCEPTED = "accepted"
UNKNOWN_KEY = "unrecognised key"
UNKNOWN_TABLE = "unknown table"
UNKNOWN_EXTENSION = "unsupported extension"


def key_columns(key: Column) -> dict[str, Column]:
    """Table, date, file name and extension out of a file key; all null for other keys."""
    part = {group: F.regexp_extract(key, KEY_PATTERN, group) for group in range(1, 6)}
    known = part[1] != ""
    name = F.element_at(F.split(part[5], "/"), -1)
    return {
        "table_name": F.when(known, part[1]),
        "ingest_date": F.when(known, F.concat_ws("-", part[2], part[3], part[4])),
        "filename": F.when(known, name),
        "ext": F.when(known, F.regexp_extract(name, r"(\.[^.]*)$", 1)),
    }


def classify(files: DataFrame, key: str, tables: Sequence[str] = schemas.ENTITIES) -> DataFrame:
    """Add the key columns and a status to rows that name a file in column ``key``."""
    status = (F.when(F.col("table_name").isNull(), UNKNOWN_KEY)
              .when(~F.col("table_name").isin(list(tables)), UNKNOWN_TABLE)
              .when(~F.col("ext").isin(EXTENSIONS), UNKNOWN_EXTENSION)
              .otherwise(ACCEPTED))
    return files.withColumns(key_columns(F.col(key))).withColumn("status", status)


def classify_events(events: DataFrame, key: str, tables: Sequence[str] = schemas.ENTITIES) -> DataFrame:
    """The same for keys as events carry them, that is URL-encoded."""
    decoded = F.coalesce(F.try_url_decode(F.col(key)), F.col(key))
    return classify(events.withColumn(key, decoded), key, tables)


def file_manifest(spark: SparkSession, root: str,
                  tables: Sequence[str] = schemas.ENTITIES) -> DataFrame:
    """One row per file below ``root``. Only file metadata is read, never the content."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
             .select(F.col("path").alias("key"), F.col("length").alias("size_bytes"),
                     F.col("modificationTime").alias("last_modified")))
    return classify(files, "key", tables).withColumn("size_mb", F.round(F.col("size_bytes") / 1048576, 3))


# Files of one path, size and time of change are the same file.
FILE_STATE = ["key", "size_bytes", "last_modified"]
STORED = ("key string, size_bytes bigint, last_modified timestamp, table_name string, ingest_date string, filename string, "
          "ext string, status string, size_mb double")


def stored(spark: SparkSession, store: str) -> DataFrame:
    """The files that earlier runs recorded; none before the first."""
    return spark.read.schema(STORED).parquet(store) if folder_exists(spark, store) else spark.createDataFrame([], STORED)


def unread(files: DataFrame, known: DataFrame) -> DataFrame:
    """The accepted files of a manifest that ``known`` lacks in their present state."""
    return files.filter(F.col("status") == ACCEPTED).join(known.select(*FILE_STATE), FILE_STATE, "left_anti")


def record(files: DataFrame, store: str) -> None:
    """Add files to the stored manifest."""
    files.select("key", "size_bytes", "last_modified", "table_name", "ingest_date", "filename", "ext", "status",
                 "size_mb").write.mode("append").parquet(store)


def ingest_summary(manifest: DataFrame) -> DataFrame:
    """Files and bytes per table and status."""
    return (manifest.groupBy("table_name", "status")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("bytes")))


def ingest_totals(manifest: DataFrame) -> DataFrame:
    """One row: all files, accepted files and skipped files."""
    return manifest.agg(F.count(F.lit(1)).alias("total_records"),
                        F.count_if(F.col("status") == ACCEPTED).alias("processed_count"),
                        F.count_if(F.col("status") != ACCEPTED).alias("skipped_count"))
