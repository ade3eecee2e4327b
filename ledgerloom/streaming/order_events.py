"""Order events as JSON lines: into the raw layer, and cleaned into versions of orders."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ledgerloom import schemas
from ledgerloom.operators.clean import REJECT, quarantine, silver
from ledgerloom.operators.dedup import latest_by_key
from ledgerloom.sources.staging import folder_exists, remove_folder

BROKEN = "_corrupt_record"
FILES_PER_BATCH = 1000
ROWS_PER_FILE = 100_000
SENT, FAILED = "sent", "failed"
COUNTS = "received bigint, failed bigint, sent bigint, batch_id bigint"
SINK_COUNTS = "batch_id bigint, received bigint, failed bigint, sent bigint"


def read_events(spark: SparkSession, source: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """The event stream with all fields as text and the line itself where it is no JSON."""
    return (spark.readStream.schema(f"{schemas.raw_ddl('orders')}, {BROKEN} string")
            .option("columnNameOfCorruptRecord", BROKEN).option("mode", "PERMISSIVE")
            .option("maxFilesPerTrigger", files_per_batch).json(source))


def stream_to_bronze(spark: SparkSession, source: str, target: str, checkpoint: str,
                     files_per_batch: int = FILES_PER_BATCH) -> StreamingQuery:
    """Copy events into Parquet by arrival date, unreadable lines included; runs until no file is left."""
    events = read_events(spark, source, files_per_batch).withColumn(
        "ingest_date", F.to_date(F.col("_metadata.file_modification_time")))
    return (events.writeStream.format("parquet").partitionBy("ingest_date")
            .option("path", target).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


class BatchCounts(StreamingQueryListener):
    """Events received and failed per batch of one named stream, as they were observed on their way to its sink."""

    def __init__(self, name: str):
        self.name, self.run, self.batches, self.ended = name, None, {}, Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run = event.runId

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if event.progress.runId == self.run and seen is not None and seen["received"]:
            self.batches[event.progress.batchId] = (seen["received"], seen["failed"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run:
            self.ended.set()


def stream_to_json(spark: SparkSession, source: str, target: str, checkpoint: str, rows_per_file: int = ROWS_PER_FILE,
                   files_per_batch: int = FILES_PER_BATCH, patience: float = 60.0) -> DataFrame:
    """Copy events into JSON files of at most ``rows_per_file`` rows, each event once; gives the counts per batch of this run.

    Events lie under ``state=sent``, lines that are no JSON under ``state=failed``, so nothing is lost. Counts are observed while the sink
    writes and reach the driver as one row per batch with the progress of the stream; the files are not read for them. ``patience`` is how
    many seconds the last progress may take to arrive once the stream has ended; it is an error if it does not. The stream runs until no
    file is left and resumes later.
    """
    name = f"events_{uuid.uuid4().hex}"
    counts, failed = BatchCounts(name), F.col(BROKEN).isNotNull()
    events = (read_events(spark, source, files_per_batch).withColumn("state", F.when(failed, FAILED).otherwise(SENT))
              .observe(name, F.count(F.lit(1)).alias("received"), F.count_if(failed).alias("failed")))
    spark.streams.addListener(counts)
    try:
        (events.writeStream.format("json").queryName(name).partitionBy("state").option("path", target)
         .option("maxRecordsPerFile", rows_per_file).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())
        if not counts.ended.wait(patience):
            raise TimeoutError("the stream's progress did not arrive")
    finally:
        spark.streams.removeListener(counts)
    rows = [(batch, received, broken, received - broken) for batch, (received, broken) in sorted(counts.batches.items())]
    return spark.createDataFrame(rows, SINK_COUNTS)


def read_json_events(spark: SparkSession, target: str, state: str = SENT) -> DataFrame:
    """Events that ``stream_to_json`` copied, or the lines that failed as ``_corrupt_record``; files of batches that broke off are not read."""
    types = f"{schemas.raw_ddl('orders')}, {BROKEN} string, state string"
    rows = spark.read.option("columnNameOfCorruptRecord", "_unread").schema(types).json(target).where(F.col("state") == state).drop("state")
    return rows.select(BROKEN) if state == FAILED else rows.drop(BROKEN)


def _write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Replace the partition of this batch, so a repeated batch leaves one copy."""
    (rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


def batch_writer(target: str, processing_date: str,
                 clock: datetime | None = None) -> Callable[[DataFrame, int], None]:
    """Per micro-batch: clean rows, rejected rows and counts, each under its batch number.

    Rejected rows include the lines that could not be read, as ``line``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            readable = batch.filter(F.col(BROKEN).isNull())
            clean = silver("orders", readable.drop(BROKEN), processing_date, clock)
            _write_batch(clean, f"{target}/versions", batch_id)
            broken = batch.filter(F.col(BROKEN).isNotNull()).select(
                F.lit("unreadable line").alias(REJECT), F.col(BROKEN).alias("line"))
            _write_batch(quarantine("orders", readable).unionByName(broken, allowMissingColumns=True),
                         f"{target}/rejected", batch_id)
            _write_batch(batch.agg(F.count(F.lit(1)).alias("received"),
                                   F.count_if(F.col(BROKEN).isNotNull()).alias("failed"),
                                   F.count_if(F.col(BROKEN).isNull()).alias("sent")),
                         f"{target}/counts", batch_id)
        finally:
            batch.unpersist()

    return write


def stream_silver_orders(spark: SparkSession, source: str, target: str, checkpoint: str,
                         processing_date: str, clock: datetime | None = None,
                         files_per_batch: int = FILES_PER_BATCH) -> StreamingQuery:
    """Clean events into versions of orders; runs until no file is left and resumes later.

    Batch numbers belong to the checkpoint: a target is to be used with one checkpoint only.
    """
    return (read_events(spark, source, files_per_batch).writeStream
            .foreachBatch(batch_writer(target, processing_date, clock))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


_MERGES = "generation bigint, upto bigint"


def _generation(spark: SparkSession, target: str) -> int | None:
    """The newest merge that was committed; one that broke off has no row in ``merges``."""
    if not folder_exists(spark, f"{target}/merges"):
        return None
    return spark.read.schema(_MERGES).parquet(f"{target}/merges").agg(F.max("generation")).first()[0]


def _merged_path(target: str, generation: int) -> str:
    return f"{target}/current/generation={generation}"


def _streamed(spark: SparkSession, target: str) -> DataFrame:
    """The latest version per order with its batch: the newest merged table and all batches that lie beside it.

    A batch that is also in the merged table changes nothing, as the latest of the same versions is the same.
    """
    types = schemas.ddl({**schemas.SILVER_TYPES["orders"], "batch_id": "bigint"})
    versions = spark.read.schema(types).parquet(f"{target}/versions")
    generation = _generation(spark, target)
    if generation is not None:
        versions = versions.unionByName(spark.read.schema(types).parquet(_merged_path(target, generation)))
    return latest_by_key(versions, ["order_id"], ["updated_at", "batch_id"])


def read_streamed_orders(spark: SparkSession, target: str) -> DataFrame:
    """The latest version per order over all batches."""
    return _streamed(spark, target).drop("batch_id")


def merge_batches(spark: SparkSession, target: str) -> None:
    """Fold all batches so far into one table of current orders and remove them, so the store holds one version per order.

    Run it between two runs of the stream. The table counts from the moment its row in ``merges`` is written; before that,
    readers see the earlier table and all batches, and the next merge begins anew. Batches are removed after that; one that is left, or
    that the stream replays later, is read beside the table and folded in again. The table of the merge before stays for its readers.
    """
    batches = [row[0] for row in spark.read.schema("batch_id bigint").parquet(f"{target}/versions")
               .select("batch_id").distinct().collect()]  # one number per batch since the last merge
    if not batches:
        return
    before = _generation(spark, target)
    generation = 0 if before is None else before + 1
    _streamed(spark, target).hint("rebalance").write.mode("overwrite").parquet(_merged_path(target, generation))
    commit_merge(spark, target, generation, max(batches))
    for batch in batches:
        remove_folder(spark, f"{target}/versions/batch_id={batch}")
    if generation > 1:
        remove_folder(spark, _merged_path(target, generation - 2))


def commit_merge(spark: SparkSession, target: str, generation: int, upto: int) -> None:
    """Make a merged table the one to read: one row in one file, there or not."""
    spark.createDataFrame([(generation, upto)], _MERGES).coalesce(1).write.mode("append").parquet(f"{target}/merges")


def read_batch_counts(spark: SparkSession, target: str) -> DataFrame:
    """Events received, sent on and failed per batch."""
    return spark.read.schema(COUNTS).parquet(f"{target}/counts")
