"""Token counts with a digest cache.

Counts are stored by the digest of a text and of the tokenizer (file and library version). Texts
whose digest is not stored are encoded once per distinct text and their counts appended; the counts of
all documents are then read from the store by a join of digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm._frames import Workspace
from ledgerloom.llm._tokenizer import shared_encoder, tokenizer_version
from ledgerloom.llm._words import as_bytes
from ledgerloom.sources.staging import folder_exists

LIMIT = 1024
RECENT = 200_000  # digests a task remembers to pass on each text once
CACHE = "content binary, tokenizer string, n_tokens int"


def _distinct_texts(docs: DataFrame) -> DataFrame:
    """Digest and text; a task passes on a text it has lately seen only once, so hot copies are few."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            texts, kept = as_bytes(batch.column("text")), {}
            for at, text in enumerate(texts):
                digest = hashlib.sha256(text).digest()
                if digest not in seen:
                    seen.add(digest)
                    kept[digest] = at
            if len(seen) > RECENT:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.binary()), pa.array([texts[at] for at in kept.values()], pa.binary())],
                                             ["content", "text"])
    return docs.select("text").mapInArrow(over, "content binary, text binary")


def _encoded(texts: DataFrame, path: str) -> DataFrame:
    """Counts of texts that lie by digest; repeats in a partition are encoded once."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = shared_encoder(path, counts_only=True), set()
        for batch in batches:
            rows = [(content, encoder(text.decode("utf-8", "replace")))
                    for content, text in dict(zip(*(batch.column(name).to_pylist() for name in ("content", "text")), strict=True)).items()
                    if content not in seen]
            seen.update(content for content, _ in rows)
            yield pa.RecordBatch.from_arrays([pa.array([row[0] for row in rows], pa.binary()), pa.array([row[1] for row in rows], pa.int32())],
                                             ["content", "n_tokens"])
    return texts.mapInArrow(over, "content binary, n_tokens int")


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document.

    ``docs`` has ``doc_id`` and ``text``; a null text counts as empty, 0 tokens. ``cache`` is a folder kept between
    runs, a new one in the shared folder unless given; two runs at once may store a count twice, which changes no result. Rows
    that repeat an id, also a null one, are counted one by one. An empty table gives no rows.
    """
    work = Workspace(docs.sparkSession, "token_counts")
    cache, version = cache or f"{work.folder}/cache", tokenizer_version(tokenizer)
    texts = _distinct_texts(docs)
    if folder_exists(docs.sparkSession, cache):
        stored = docs.sparkSession.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version)
        misses = texts.join(stored, "content", "left_anti").repartition("content")
    else:
        misses = texts.repartition("content")
    work.append(_encoded(misses, tokenizer).withColumn("tokenizer", F.lit(version)).select("content", "tokenizer", "n_tokens"), cache)
    stored = (docs.sparkSession.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version)
              .groupBy("content").agg(F.min("n_tokens").cast("bigint").alias("n_tokens")))
    text = F.coalesce("text", F.lit(""))
    keys = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.octet_length(text).cast("bigint").alias("n_bytes"),
                       F.unhex(F.sha2(text, 256)).alias("content"))
    return keys.join(stored, "content").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
