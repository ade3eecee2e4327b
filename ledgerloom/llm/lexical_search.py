"""Ranked lexical search without random access (NRA) over lists sorted by impact.

Spark counts terms per document once and adds up what the weights need. A task then takes its documents in shards of
a bounded number of postings, sorts the list of each term by the share it adds to a score, and reads the
lists of an item one after the other from the highest share on, all down to the same share in each round. What has been read bounds
the score of every document from below; adding the largest shares that are left bounds it from above. An item
takes no new documents when an unread one could not reach the k-th best lower bound so far, drops those whose
upper bound is below it, and is finished in a shard when the bounds of all others agree, at the latest when the lists
end. The best documents of a task go on from shard to shard, so later ones stop earlier; Spark merges the tasks'.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from heapq import nsmallest
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm._frames import Workspace, map_arrow
from ledgerloom.llm._words import as_bytes, token_hashes

BEST = 20
FILTER_BITS = 1 << 22  # of the filter that keeps terms of no item out of the postings; its size never changes
SHARD = 1 << 20  # postings whose lists a task holds at once
PASS_TERMS = 1_000_000  # terms of items that a task holds; more are looked for in several passes over the postings
STEP = 0.7  # every round reads the lists down to this part of the share of the round before

# a term is a run of ASCII letters, digits and characters beyond ASCII; only A-Z are lower-cased
_LOWER = bytes(byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or chr(byte).isalnum() else 32 for byte in range(256))


def _filter(terms: DataFrame) -> np.ndarray:
    """A bit for the hash of each term, in an array of FILTER_BITS bits."""
    rows = terms.select((F.col("term").bitwiseAND(FILTER_BITS - 1)).alias("bit")).groupBy(
        F.shiftright("bit", 5).alias("place")).agg(F.bit_or(F.expr("1L << int(bit & 31)")).alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS >> 5, np.uint32)
    bits[rows["place"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint32)
    return bits


def _terms(rows: DataFrame, key: str, kept: np.ndarray | None = None) -> DataFrame:
    """``node, <key>, n, terms, times`` of the rows with a term; only terms whose bit is in ``kept`` are listed, n counts all."""
    def over(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [text.translate(_LOWER) for text in as_bytes(batch.column("text"))]
        at, sizes, ends, terms, times = [], [], [0], [], []
        for group in token_hashes(texts):
            for place, (low, high) in enumerate(zip(group.offsets[:-1], group.offsets[1:], strict=True)):
                if high > low:
                    found, count = np.unique(group.values[low:high], return_counts=True)
                    if kept is not None:
                        bit = found & np.uint64(FILTER_BITS - 1)
                        listed = (kept[bit >> np.uint64(5)] >> (bit & np.uint64(31)).astype(np.uint32) & 1).astype(bool)
                        found, count = found[listed], count[listed]
                    at.append(group.first + place)
                    sizes.append(high - low)
                    ends.append(ends[-1] + len(found))
                    terms.append(found)
                    times.append(count)
        if at:
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(parts).astype(kind))) for parts, kind in ((terms, np.int64), (times, np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(at)), batch.column(key).take(pa.array(at)),
                                              pa.array(sizes, pa.int64()), *lists], ["node", key, "n", "terms", "times"])

    whole = rows.select(F.monotonically_increasing_id().alias("node"), key, F.col("text").cast("binary").alias("text"))
    return map_arrow(whole, over, f"node long, {key} {rows.schema[key].dataType.simpleString()}, n long, terms array<long>, times array<int>")


class Asked(NamedTuple):
    """The items of one pass: their terms with weights, and per item the places of its terms among them and how often it holds each."""

    terms: np.ndarray
    weights: np.ndarray
    items: list[tuple[int, np.ndarray, np.ndarray]]
    documents: int
    total: int


class _Lists:
    """The lists of a shard, each sorted by falling share."""

    def __init__(self, asked: Asked, batches: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(batches).combine_chunks()
        self.ids = rows["doc_id"]
        terms = rows["terms"].combine_chunks()
        counts = np.diff(terms.offsets.to_numpy())
        found = terms.flatten().to_numpy()
        times = rows["times"].combine_chunks().flatten().to_numpy().astype(np.int64)
        docs = np.repeat(np.arange(len(rows), dtype=np.int32), counts)
        place = np.minimum(np.searchsorted(asked.terms, found), len(asked.terms) - 1)
        m = 75 + (25 * rows["n"].to_numpy() * asked.documents) // asked.total
        share = asked.weights[place] * ((1_000_000_000 * times) // (1000 * times + 12 * m[docs]))
        kept = np.flatnonzero((asked.terms[place] == found) & (share > 0))
        kept = kept[np.lexsort((-share[kept], place[kept]))]
        self.docs, self.share = docs[kept], share[kept]
        self.bounds = np.searchsorted(place[kept], np.arange(len(asked.terms) + 1))

    def best(self, places: np.ndarray, times: np.ndarray, best: int, have: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents that can be among the ``best`` beside those with scores ``have``, and their scores."""
        bound = have.min() if len(have) == best else 0
        lists = [(self.docs[low:high], self.share[low:high] * count) for low, high, count in
                 zip(self.bounds[places], self.bounds[places + 1], times, strict=True) if high > low]
        tops = np.array([shares[0] for _, shares in lists], np.int64)
        lower = np.zeros(len(self.ids), np.int64)
        if tops.sum() == 0 or tops.sum() < bound:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        read, falling = [0] * len(lists), [-shares for _, shares in lists]
        level = float(tops.max())
        while True:
            level *= STEP
            left = np.zeros(len(lists), np.int64)
            for at, (docs, shares) in enumerate(lists):
                end = int(np.searchsorted(falling[at], -level, "right"))
                if end > read[at]:
                    lower[docs[read[at]:end]] += shares[read[at]:end]
                    read[at] = end
                if read[at] < len(shares):
                    left[at] = shares[read[at]]
            unread = left.sum()
            scores = np.concatenate([have, lower[lower > 0]])
            bound = np.partition(scores, len(scores) - best)[len(scores) - best] if len(scores) >= best else 0
            if unread > 0 and unread >= bound:
                continue
            seen = np.zeros(len(lower), np.int64)
            for at, (docs, _) in enumerate(lists):
                if left[at]:
                    seen[docs[:read[at]]] += left[at]
            upper = lower + (unread - seen)
            open_ = np.flatnonzero((lower > 0) & (upper >= bound))
            if np.array_equal(upper[open_], lower[open_]):
                return open_, lower[open_]


def _search(texts: DataFrame, asked: Asked, best: int, id_type: str) -> DataFrame:
    """``item, doc_id, score``: the best documents of every item in each task's part of the texts."""
    shared = texts.sparkSession.sparkContext.broadcast(asked)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, waiting, postings = shared.value, [], 0
        found: list[list[tuple]] = [[] for _ in asked.items]

        def shard() -> None:
            lists = _Lists(asked, waiting)
            for at, (_, places, times) in enumerate(asked.items):
                have = found[at]
                docs, scores = lists.best(places, times, best, np.array([-one[0] for one in have], np.int64))
                if len(docs):
                    ids = lists.ids.take(pa.array(docs)).to_pylist()
                    new = ((-score, doc_id is None, 0 if doc_id is None else doc_id) for score, doc_id in zip(scores.tolist(), ids, strict=True))
                    found[at] = nsmallest(best, [*have, *new])

        for batch in batches:
            waiting.append(batch)
            postings += len(batch.column("terms").flatten())
            if postings >= SHARD:
                shard()
                waiting, postings = [], 0
        if waiting:
            shard()
        rows = [(item, None if null else doc_id, -score) for (item, _, _), have in zip(asked.items, found, strict=True) for score, null, doc_id in have]
        for low in range(0, len(rows), 10_000):
            columns = zip(*rows[low:low + 10_000], strict=True)
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, columns, strict=True)), schema)

    schema = pa.schema([("item", pa.int64()), ("doc_id", _arrow_type(texts)), ("score", pa.int64())])
    return texts.select("doc_id", "n", "terms", "times").mapInArrow(over, f"item long, doc_id {id_type}, score long")


def _arrow_type(texts: DataFrame) -> pa.DataType:
    return texts.select("doc_id").limit(0).toArrow().schema.field("doc_id").type


def _passes(asked: DataFrame, weights: DataFrame, documents: int, total: int) -> Iterator[Asked]:
    """The items with the weights of their terms, at most PASS_TERMS terms and one item at a time."""
    running = Window.orderBy("item").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = asked.groupBy("item").agg(F.count(F.lit(1)).alias("size"))
    cuts = sizes.select("item", F.floor(F.sum("size").over(running) / PASS_TERMS).alias("pass"))
    rows = asked.join(weights, "term").join(cuts, "item")
    for (at,) in rows.select("pass").distinct().orderBy("pass").toLocalIterator():
        part = rows.where(F.col("pass") == at).select("item", "term", "times", "weight").orderBy("item").toArrow()
        item, term, times, weight = (part[name].to_numpy() for name in part.column_names)
        terms, first, places = np.unique(term, return_index=True, return_inverse=True)
        starts = np.flatnonzero(np.diff(item, prepend=item[:1] - 1))
        items = [(int(item[low]), places[low:high], times[low:high]) for low, high in
                 zip(starts, [*starts[1:], len(item)], strict=True)]
        yield Asked(terms, weight[first], items, documents, total)


def ranked_search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents of every item by score, those above 0.

    ``docs`` has ``doc_id, text``, ``items`` has ``item_id, text``; both are taken whole. Each row is a document or
    item of its own, also if its id is null or repeated. Equal scores go by ascending id, null last. Null texts
    and texts without a term, however long, count for nothing and are never found; empty tables give no rows.
    Other columns are ignored, whatever their names. Terms are compared by 64-bit hashes.
    """
    work = Workspace(docs.sparkSession, "search")
    asked = work.stage(_terms(items, "item_id").select(
        F.col("node").alias("item"), "item_id", F.explode(F.arrays_zip("terms", "times")).alias("one")).select(
        "item", "item_id", F.col("one.terms").alias("term"), F.col("one.times").cast("long").alias("times")), "items")
    terms = asked.select("term").distinct()
    texts = work.stage(_terms(docs.select("doc_id", "text"), "doc_id", _filter(terms)), "texts")
    documents, total = texts.agg(F.count("n"), F.coalesce(F.sum("n"), F.lit(1))).first()
    holders = texts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).join(terms, "term")
    weights = work.stage(holders.select(
        "term", F.floor(1000 * F.log((F.lit(2.0) * documents + 2) / (2 * F.col("df") + 1))).alias("weight")), "weights")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    none = work.spark.createDataFrame([], f"item long, doc_id {id_type}, score long")
    found = reduce(DataFrame.unionByName, (_search(texts, one, best, id_type) for one in _passes(asked, weights, documents, total)), none)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.join(asked.select("item", "item_id").distinct(), "item").select("item_id", "rank", "doc_id", "score")
