"""Quality rules: hashed n-gram log-likelihood ratio of trusted text against the raw corpus.

Two multinomials over hashed one- and two-token n-grams are counted: one over every document, one
over the documents labelled good. The mean log ratio over a document's n-grams says how much more
its wording is that of the trusted part; a document below the threshold is rejected. Plain counts
per document (length, symbols, repeated lines and windows) reject some before that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm._frames import Workspace, map_arrow
from ledgerloom.llm._words import BLANKS, TOKEN_CLASSES, Hashes, as_bytes, token_hashes, window_hashes

TRUSTED_SAMPLE = 20_000  # labelled documents the target model is fitted on, at most
BITS = 12  # of the bucket of an n-gram; one- and two-token n-grams have tables of their own. Few buckets even out rare words
BUCKETS = 2 << BITS
SMOOTHING = 1.0
UNIT = 1 << 24  # ratios are whole numbers of 1 / UNIT, so sums do not depend on the order
THRESHOLD = -0.3  # least mean log ratio of a kept document
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SCORES = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "n_ngrams bigint, llr double")


def ngram_buckets(group: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the one- and two-token n-grams that start at each token of a group of texts.

    The last token of a text starts no pair; its place in the second array means nothing.
    """
    mask = np.uint64((1 << BITS) - 1)
    pairs = np.append(window_hashes(group.values, 2), np.zeros(min(1, len(group.values)), np.uint64))
    return (group.values & mask).astype(np.int64), ((pairs & mask) + np.uint64(1 << BITS)).astype(np.int64)


def _count(group: Hashes, texts: range | list[int]) -> np.ndarray:
    """N-grams per bucket in some texts of a group."""
    single, pairs = ngram_buckets(group)
    found = []
    for at in texts:
        low, high = group.offsets[at], group.offsets[at + 1]
        found += [single[low:high], pairs[low:max(low, high - 1)]]
    return np.bincount(np.concatenate(found), minlength=BUCKETS) if found else np.zeros(BUCKETS, np.int64)


def _texts_of(group: Hashes) -> Iterator[np.ndarray]:
    for low, high in zip(group.offsets[:-1], group.offsets[1:], strict=True):
        yield group.values[low:high]


def ngram_counts(docs: DataFrame) -> DataFrame:
    """``bucket, raw_count, trusted_count`` of documents with ``text, trusted``."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            trusted = batch.column("trusted").to_pylist()
            texts = [text.lower() for text in as_bytes(batch.column("text"))]
            for group in token_hashes(texts, TOKEN_CLASSES):
                members = range(len(group.offsets) - 1)
                counts[0] += _count(group, members)
                counts[1] += _count(group, [at for at in members if trusted[group.first + at]])
        used = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[0][used]), pa.array(counts[1][used])],
                                         ["bucket", "raw_count", "trusted_count"])
    rows = docs.select("text", "trusted").mapInArrow(counted, "bucket int, raw_count bigint, trusted_count bigint")
    return rows.groupBy("bucket").agg(F.sum("raw_count").alias("raw_count"), F.sum("trusted_count").alias("trusted_count"))


def log_ratios(docs: DataFrame, labels: DataFrame, sample: int = TRUSTED_SAMPLE) -> np.ndarray:
    """The log ratio per bucket, in units of 1 / UNIT; all 0 when no labelled document is good.

    The target is fitted on at most ``sample`` labelled documents, those with the smallest hash of
    their id; the raw model on all documents. The driver gets one row per bucket, a fixed number.
    """
    good = (labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).withColumn("trusted", F.lit(True)))
    marked = docs.select("doc_id", "text").join(F.broadcast(good), "doc_id", "left")
    table = ngram_counts(marked.withColumn("trusted", F.coalesce("trusted", F.lit(False)))).toArrow()
    counts = np.zeros((2, BUCKETS))
    at = table.column("bucket").to_numpy()
    counts[0, at], counts[1, at] = table.column("raw_count").to_numpy(), table.column("trusted_count").to_numpy()
    if not counts[1].any():
        return np.zeros(BUCKETS, np.int64)
    raw, trusted = (np.log((row + SMOOTHING) / (row.sum() + SMOOTHING * BUCKETS)) for row in counts)
    return np.rint((trusted - raw) * UNIT).astype(np.int64)


def repeat_words(values: np.ndarray, size: int = 3) -> int:
    """Words in windows of ``size`` words that occur twice or more in the text."""
    windows = window_hashes(values, size)
    if len(windows) < 2:
        return 0
    _, at, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[at] > 1
    covered = np.zeros(len(values), bool)
    for place in range(size):
        covered[place:place + len(again)] |= again
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))


def quality_scores(docs: DataFrame, ratios: np.ndarray, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every document with its counts and its mean log ratio (0 without tokens)."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    names = [part.split()[0] for part in SCORES.split(", ")]

    def scored(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = as_bytes(batch.column("text"))
        points = batch.column("text").to_pylist()
        n_words, repeats = [], []
        for group in token_hashes(texts):
            for values in _texts_of(group):
                n_words.append(len(values))
                repeats.append(repeat_words(values))
        n_ngrams, ratio = [], []
        for group in token_hashes([text.lower() for text in texts], TOKEN_CLASSES):
            singles, pairs = (np.concatenate([[0], np.cumsum(shared.value[found])]) for found in ngram_buckets(group))
            for low, high in zip(group.offsets[:-1], group.offsets[1:], strict=True):
                size = max(0, 2 * (high - low) - 1)
                total = singles[high] - singles[low] + pairs[max(low, high - 1)] - pairs[low]
                n_ngrams.append(size)
                ratio.append(int(total) / UNIT / size if size else 0.0)
        columns = [n_words,
                   [len(point or "") - len(text) + len(text.translate(None, BLANKS)) for point, text in zip(points, texts, strict=True)],
                   [len(text) - len(text.translate(None, SYMBOLS)) for text in texts],
                   [duplicate_lines(text) for text in texts], repeats, n_ngrams]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in keep), *(pa.array(column, pa.int64()) for column in columns),
             pa.array(ratio, pa.float64())], [*keep, *names])
    kept = docs.select(*keep, *([] if "text" in keep else ["text"]))
    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in docs.select(*keep).schema)
    return map_arrow(kept, scored, f"{schema}, {SCORES}")


def quality_rules(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None,
                  threshold: float = THRESHOLD) -> DataFrame:
    """Every document with its counts, ``llr``, ``base_failed`` and ``kept``.

    ``docs`` has ``doc_id`` and ``text``; ``labels`` has ``doc_id`` and ``quality`` (1 is good). ``keep`` names the
    columns of ``docs`` to carry along (``doc_id`` alone unless given); none may be called as a result column.
    A null or empty text counts 0 words and fails. Without good labels the ratio is 0 and only the counts
    decide. Rows that repeat an id are judged one by one. An empty table gives no rows.
    """
    Workspace(docs.sparkSession, "quality")
    rows = quality_scores(docs, log_ratios(docs, labels), keep or ["doc_id"])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("llr") >= threshold))
