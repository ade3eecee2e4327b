"""Token ids as length-delimited binary records with an offset index.

A file is a run of records: the payload's length (8 bytes), a masked checksum of those bytes (4), the
payload, and a masked checksum of it (4), all little-endian. Checksums are CRC-32, rotated and
shifted by a constant so that a checksum of data that holds checksums stays sound. The payload is the
document's id (8 bytes), a byte that is 1 if the id is null, the width of an id in bytes (1), and the
ids. The index, a Parquet table beside the files, has file, offset and length of every record,
so a reader can fetch records in any order.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm._frames import Workspace
from ledgerloom.llm._tokenizer import shared_encoder

END_ID = 0
MASK_SHIFT = 0xA282EAD8  # added to the rotated checksum
LENGTH, CHECK, HEAD = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<qBB")
FRAME_BYTES = LENGTH.size + 2 * CHECK.size

INDEX = "part int, file string, doc_id bigint, offset bigint, length bigint, n_tokens bigint"
READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, file string, offset bigint"


def masked_checksum(data: bytes) -> bytes:
    value = zlib.crc32(data)
    return CHECK.pack(((value >> 15 | value << 17) + MASK_SHIFT) & 0xFFFFFFFF)


def framed(doc_id: int | None, ids: bytes, width: int) -> bytes:
    payload = HEAD.pack(doc_id or 0, doc_id is None, width) + ids
    length = LENGTH.pack(len(payload))
    return b"".join((length, masked_checksum(length), payload, masked_checksum(payload)))


def unframed(record: bytes) -> tuple[int | None, np.ndarray]:
    """Id and token ids of a record; a ValueError says which part is damaged."""
    if len(record) < FRAME_BYTES or masked_checksum(record[:8]) != record[8:12]:
        raise ValueError("the length of a record is damaged")
    size = LENGTH.unpack(record[:8])[0]
    payload = record[12:12 + size]
    if len(record) != size + FRAME_BYTES or masked_checksum(payload) != record[12 + size:]:
        raise ValueError("the payload of a record is damaged")
    doc_id, null, width = HEAD.unpack(payload[:HEAD.size])
    return None if null else doc_id, np.frombuffer(payload, f"<u{width}", offset=HEAD.size)


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that all executors reach, and the folder's path in it."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def write_records(docs: DataFrame, tokenizer: str, folder: str, by_id: bool = True) -> DataFrame:
    """Write the records in ascending id order or as the rows lie; gives the index, ordered by part and offset.

    A task writes one file under a name of its own; a repeated attempt writes another one, and the index names
    that of the attempt that counted.
    """
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = shared_encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([END_ID], f"<u{encoder.width}").tobytes()
        store, root = file_system(folder)
        name, offset, out = f"part-{part:06d}-{uuid.uuid4().hex}.records", 0, None
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = encoder(text or "") + end
                record = framed(doc_id, ids, encoder.width)
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(f"{root}/{name}")
                out.write(record)
                rows.append((doc_id, offset, len(record), len(ids) // encoder.width))
                offset += len(record)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(rows), pa.int32()), pa.array([name] * len(rows)),
                     *(pa.array([row[at] for row in rows], pa.int64()) for at in range(4))],
                    ["part", "file", "doc_id", "offset", "length", "n_tokens"])
        if out is not None:
            out.close()
    if not by_id:
        return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(over, INDEX)
    # ids alone might put a third of all rows into one range
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return ordered.select("doc_id", "text").mapInArrow(over, INDEX)


def indexed(index: DataFrame) -> DataFrame:
    """The index with ``start``, the ids of all records before each."""
    files = index.groupBy("part", "file").agg(F.sum("n_tokens").alias("total"))
    before = files.select("file", F.coalesce(F.sum("total").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.coalesce(F.sum("n_tokens").over(
        Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return index.withColumn("inside", inside).join(before, "file").select(
        "file", "offset", "length", "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that the index rows name, read from their files and checked.

    Needs ``file, offset, length, start``, in any order; neighbours in one file share its handle.
    """
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        name, source = None, None
        for batch in batches:
            rows = []
            columns = (batch.column(column).to_pylist() for column in ("file", "offset", "length", "start"))
            for file, offset, length, start in zip(*columns, strict=True):
                if file != name:
                    name, source = file, store.open_input_file(f"{root}/{file}")
                source.seek(offset)
                doc_id, ids = unframed(source.read(length))
                rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), file, offset))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([row[at] for row in rows], kind) for at, kind in enumerate(kinds)],
                                             ["doc_id", "start", "n_tokens", "ids_crc32", "file", "offset"])
    return index.select("file", "offset", "length", "start").mapInArrow(over, READ)


def binary_records(docs: DataFrame, tokenizer: str, folder: str | None = None, by_id: bool = True) -> DataFrame:
    """Encode every document, write the records, and read them back: one row per document from the files.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Each sequence ends with id 0, so a null or
    empty text gives that one id. Order is by id, nulls first, equal ids by a hash of the text, or, without ``by_id``,
    that of the partitions of ``docs``; ``start`` counts the ids of all records before. ``folder`` must be reached by all executors and by pyarrow's file systems; unless given, a new
    one in the shared folder is used. An empty table writes no file and gives no rows.
    """
    work = Workspace(docs.sparkSession, "records")
    target = folder or f"{work.folder}/records"
    index = work.stage(indexed(work.stage(write_records(docs, tokenizer, target, by_id), "written")), "index")
    return read_records(index, target)
