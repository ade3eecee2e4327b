"""Readers and writers of the raw layer: ``bronze/{table}/dt=YYYY/MM/DD/``.

A range of dates written by one job has ``dt=YYYY-MM-DD`` folders; readers accept both.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from datetime import date, timedelta
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas

PATH, START = "_path", "_start"  # of rows that a union took from several scans
FORMATS = ("csv", "json", "parquet")
DATE_IN_PATH = r"/dt=(\d{4})[/-](\d{2})[/-](\d{2})/"


def read_csv(spark: SparkSession, path: str, schema: str | None = None,
             recursive: bool = False, names: str = "*") -> DataFrame:
    """CSV with a header row, all columns text unless a schema is given.

    A given schema is checked against each header, so a file whose columns come in another order
    fails instead of being read into the wrong columns. A quote within quotes is doubled.
    """
    reader = (spark.read.option("header", True).option("escape", '"')
              .option("recursiveFileLookup", recursive).option("pathGlobFilter", names))
    if schema:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def headers(spark: SparkSession, path: str | list[str], recursive: bool = False, names: str = "*.csv") -> DataFrame:
    """``file, columns`` of every text file that has a first line; no more of a file is read than its first rows.

    A task takes the first row of a part of a file and stops; only the part that begins the file counts. Run it with
    one part of a file per task, as ``_header_groups`` does.
    """
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                begins = batch.column("start")[0].as_py() == 0
                line = next(csv.reader([batch.column("value")[0].as_py().removeprefix("\ufeff")]), []) if begins else []
                yield pa.RecordBatch.from_arrays([batch.column("file")[:begins], pa.array([line][:begins], pa.list_(pa.string()))],
                                                 ["file", "columns"])
                return  # the rest of the part is not read

    lines = (spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", names).text(path)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")))
    return lines.mapInArrow(first, "file string, columns array<string>")


def _header_groups(spark: SparkSession, path: str | list[str], recursive: bool, names: str) -> list[tuple[list[str], list[str]]]:
    """Each different header with the files that have it."""
    opening = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(opening)
    spark.conf.set(opening, spark.conf.get("spark.sql.files.maxPartitionBytes"))  # so that no task gets parts of two files
    try:
        found = headers(spark, path, recursive, names).groupBy("columns").agg(F.collect_list("file").alias("files")).collect()
    finally:
        spark.conf.set(opening, before)
    return sorted((list(row["columns"]), sorted(row["files"])) for row in found)


def _read_csv(spark: SparkSession, path: str | list[str], table: str, recursive: bool, names: str) -> DataFrame:
    """Raw rows of text files, each by the header of its own file: one scan per different header.

    Columns beyond the declared ones are kept; a column that a file lacks is null there. Files of one header are
    read by the path that found them; where headers differ, each scan gets the files it reads.
    """
    groups, declared = _header_groups(spark, path, recursive, names), list(schemas.ENTITY_TYPES[table])
    parts = []
    for header, files in groups:
        # a blank or repeated name goes by its place
        columns = [name if name and name not in header[:at] else f"_c{at}" for at, name in enumerate(header)]
        reader = (spark.read.option("header", True).option("escape", '"').schema(schemas.ddl(dict.fromkeys(columns, "string")))
                  .option("recursiveFileLookup", recursive).option("pathGlobFilter", names))
        rows = reader.csv(path if len(groups) == 1 else files)
        lacking = [name for name in declared if name not in columns]
        parts.append(rows.withColumns({name: F.lit(None).cast("string") for name in lacking}))
    if not parts:  # no file has a line
        return spark.createDataFrame([], schemas.ddl(dict.fromkeys(declared, "string"))).withColumns(
            {PATH: F.lit(None).cast("string"), START: F.lit(None).cast("bigint")})
    if len(parts) == 1:
        return parts[0]
    placed = [rows.withColumns({PATH: F.col("_metadata.file_path"), START: F.col("_metadata.file_block_start")}) for rows in parts]
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), placed)


def _read_format(spark: SparkSession, path: str | list[str], table: str, file_format: str, recursive: bool,
                 names: str) -> DataFrame:
    """Raw rows of one format as text columns, of one path or of some files; ``names`` is a pattern for file names."""
    if file_format == "csv":
        return _read_csv(spark, path, table, recursive, names)
    reader = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", names)
    if file_format == "json":
        return reader.schema(schemas.raw_ddl(table)).json(path)
    stored = reader.parquet(*([path] if isinstance(path, str) else path))
    return stored.withColumns({name: F.col(name).cast("string") for name in schemas.ENTITY_TYPES[table]})


def _formats_in(spark: SparkSession, path: str) -> list[str]:
    """The accepted formats that occur among the files of a path, by extension."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    kind = F.regexp_extract(F.col("path"), r"\.(csv|json|parquet)$", 1)
    found = files.select(kind.alias("kind")).distinct().filter("kind <> ''").collect()
    return sorted(row["kind"] for row in found)


def read_raw(spark: SparkSession, path: str, table: str, file_format: str = "csv",
             recursive: bool = False) -> DataFrame:
    """Raw rows of one entity as text columns.

    ``file_format`` is one of the accepted formats, whose files alone are read, or "any" to read each file by its
    extension. Files of other extensions are left alone.
    """
    if file_format in FORMATS:
        return _read_format(spark, path, table, file_format, recursive, f"*.{file_format}")
    if file_format != "any":
        raise ValueError(f"unsupported format {file_format!r}, expected one of {FORMATS} or 'any'")
    declared = list(schemas.ENTITY_TYPES[table])
    parts = [_read_format(spark, path, table, kind, recursive, f"*.{kind}")
             .transform(lambda rows: rows.select(*declared, file_path(rows).alias(PATH)))
             for kind in _formats_in(spark, path)]
    if not parts:
        raise ValueError(f"no file of an accepted format in {path}")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def read_files(spark: SparkSession, files: Sequence[str], table: str) -> DataFrame:
    """The raw rows of the named files, each by its extension, with the ``date_partition`` of its path.

    Nothing beside these files is listed or opened.
    """
    declared, parts = list(schemas.ENTITY_TYPES[table]), []
    for kind in FORMATS:
        # characters that a path pattern would take for its own
        if own := [re.sub(r"([\\*?\[\]{}])", r"\\\1", file) for file in files if file.endswith(f".{kind}")]:
            rows = _read_format(spark, own, table, kind, False, "*")
            parts.append(rows.select(*declared, date_from_path(file_path(rows)).alias("date_partition")))
    if not parts:
        raise ValueError("no file of an accepted format given")
    return reduce(DataFrame.unionByName, parts)


def day_folder(day: date | str) -> str:
    return f"dt={str(day).replace('-', '/')}"


def day_glob(days: Sequence[date | str]) -> str:
    """One path pattern for the folders of some dates, in either layout."""
    names = [name for day in days for name in (day_folder(day), f"dt={day}")]
    return "{" + ",".join(names) + "}"


def read_day(spark: SparkSession, root: str, table: str, day: date | str,
             file_format: str = "csv") -> DataFrame:
    """The raw rows of one entity and date."""
    return read_raw(spark, f"{root}/bronze/{table}/{day_glob([day])}", table, file_format)


def date_from_path(path: Column) -> Column:
    """yyyy-MM-dd out of a raw file path, null where there is none."""
    digits = [F.regexp_extract(path, DATE_IN_PATH, group) for group in (1, 2, 3)]
    return F.when(digits[0] != "", F.concat_ws("-", *digits))


def file_path(rows: DataFrame) -> Column:
    """The file of each raw row; a union over formats or headers carries it as a column."""
    return F.col(PATH) if PATH in rows.columns else F.col("_metadata.file_path")


def read_days(spark: SparkSession, root: str, table: str, start: date, end: date,
              file_format: str = "csv") -> DataFrame:
    """The raw rows of a range of dates in one scan, each with its ``date_partition``."""
    days = [start + timedelta(days=offset) for offset in range((end - start).days + 1)]
    rows = read_raw(spark, f"{root}/bronze/{table}/{day_glob(days)}", table, file_format)
    return rows.withColumn("date_partition", date_from_path(file_path(rows)))


def read_all_days(spark: SparkSession, root: str, table: str, file_format: str = "csv") -> DataFrame:
    """Every file of an entity below its folder, with the columns that give file order."""
    rows = read_raw(spark, f"{root}/bronze/{table}", table, file_format, recursive=True)
    return with_file_order(rows)


FILE_ORDER = ["_file", "_block", "_row"]


def with_file_order(rows: DataFrame) -> DataFrame:
    """Add file path, block start and a row number that rises within a block."""
    return rows.withColumns({"_file": file_path(rows),
                             "_block": F.col(START) if START in rows.columns else F.col("_metadata.file_block_start"),
                             "_row": F.monotonically_increasing_id()})


def write_text(df: DataFrame) -> DataFrameWriter:
    """A CSV writer that keeps blanks around values and writes null and empty text as nothing."""
    return (df.write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def land_csv(df: DataFrame, root: str, table: str, day: date | str) -> str:
    """Write one batch of raw rows as CSV under its date; a rerun replaces it."""
    path = f"{root}/bronze/{table}/{day_folder(day)}"
    write_text(df).csv(path)
    return path


def land_csv_days(df: DataFrame, root: str, table: str, day_column: str) -> str:
    """Write the raw rows of many dates as CSV in one job, one folder per date.

    Each task writes the rows it holds, one file per date, so the rows are not shuffled on their way to the files.
    """
    path = f"{root}/bronze/{table}"
    rows = df.withColumnRenamed(day_column, "dt")
    write_text(rows).option("partitionOverwriteMode", "dynamic").partitionBy("dt").csv(path)
    return path


def land_json(df: DataFrame, path: str, rows_per_file: int = 0) -> str:
    """Append events as JSON lines, in files of at most ``rows_per_file`` rows if given."""
    df.write.mode("append").option("maxRecordsPerFile", rows_per_file).json(path)
    return path
