"""Cleaning driven by the stored manifest: the dates that have files no run has read yet."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators.clean import CLEAN, REJECTED, cleaned
from ledgerloom.sources import bronze, manifest, tables
from ledgerloom.sources.staging import fresh_folder, remove_folder, stage


def ingest(spark: SparkSession, raw_root: str, silver_root: str, store: str,
           clock: datetime | None = None) -> DataFrame:
    """Clean every table and date with a new or changed accepted file; gives the rows written per table.

    The manifest in ``store`` names the files of earlier runs by path, size and time of change. A clean date is replaced
    as a whole, so all accepted files of a date with a new one are read, and files of other dates are not
    opened. The new files are recorded at the end: a run that breaks off is repeated in full, a second run reads none.
    A file that is gone makes no date due. Only paths and dates of due files reach the driver, which a scan lists there anyway.
    """
    work = fresh_folder(spark, "ingest")
    try:
        files = stage(manifest.file_manifest(spark, raw_root), "files", work)
        new = stage(manifest.unread(files, manifest.stored(spark, store)), "new", work)
        dates = new.select("table_name", "ingest_date").distinct()
        due = (files.filter(F.col("status") == manifest.ACCEPTED)
               .join(dates, ["table_name", "ingest_date"], "left_semi").select("table_name", "ingest_date", "key").collect())
        written = {}
        for table in schemas.ENTITIES:
            if own := sorted((row["ingest_date"], row["key"]) for row in due if row["table_name"] == table):
                raw = bronze.read_files(spark, [key for _, key in own], table)
                written[table] = tables.write_cleaned(cleaned(table, raw, None, clock), silver_root, table, sorted({day for day, _ in own}))
        if due:
            manifest.record(new, store)
    finally:
        remove_folder(spark, work)
    return (tables.run_summary(spark, "silver", {table: counts[CLEAN] for table, counts in written.items()})
            .unionByName(tables.run_summary(spark, "rejected", {table: counts[REJECTED] for table, counts in written.items()})))
