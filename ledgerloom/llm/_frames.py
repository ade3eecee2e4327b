"""Staged tables, Arrow batches and connected components shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.staging import fresh_folder, shuffles_removed, stage

BATCH_ROWS = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


class Workspace:
    """A folder of staged tables for one run of an operator.

    The tables lie in the shared folder of ``spark.checkpoint.dir``, so lost executors cost no
    earlier stage. Shuffle files go as soon as the table that needed them is written.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.folder, self.tables = spark, fresh_folder(spark, label), 0
        if int(spark.conf.get(_ROWS)) > BATCH_ROWS:
            spark.conf.set(_ROWS, str(BATCH_ROWS))

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        self.tables += 1
        return stage(df, f"{label}-{self.tables}", self.folder)

    def append(self, df: DataFrame, path: str) -> None:
        with shuffles_removed(self.spark):
            df.write.mode("append").parquet(path)


def map_arrow(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply a function of one Arrow batch to every batch."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)
    return df.mapInArrow(over, schema)


def _same(left: DataFrame, right: DataFrame) -> bool:
    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
    return mark(left) == mark(right)


def components(work: Workspace, links: DataFrame) -> DataFrame:
    """``node, label`` of every node of the links ``a, b``; label is the smallest node reachable.

    Large-star and small-star rounds over staged edges: each round hangs the neighbours of a node
    on the smallest of them, by a minimum per node (combined before the shuffle) and a join.
    """
    edges = work.stage(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                       .distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = work.stage(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                           .distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = work.stage(large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                           .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        if _same(edges, small):
            roots = small.select(F.col("v").alias("node")).distinct()
            return small.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                roots.select("node", F.col("node").alias("label")))
        edges = small
