"""Intermediate tables in the shared folder the cluster names for checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes within go as soon as each is done, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Only a session on one machine may go without it; a folder is then made and set. Executors of
    a cluster could not see such a folder, so there its absence is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="ledgerloom-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A folder name no other run uses."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write the rows once and read them back.

    Everything built on the result sees the same rows, whatever tasks are repeated, and a lost
    executor costs no recomputation of what came before. A job that passes its own ``folder`` can
    remove it when its results are written; without one the table stays in the scratch folder.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, label) if folder is None else f"{folder}/{label}"
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of the file system the path belongs to; false where there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
