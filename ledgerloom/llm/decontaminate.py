"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters may occur with up to k = m // 16 edits, one under 32 characters with none and as whole words
only. Cut into k + 1 pieces, at least one piece of such an occurrence is unchanged. All pieces are found by one automaton in a pass over each
text; around every hit the whole item is compared by Myers' bit-parallel edit distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm._frames import Workspace

CHARS_PER_EDIT = 16
MIN_CHARS = 32  # a shorter item is looked for as it is, in whole words
PASS_CHARS = 4_000_000  # characters of items that one pass over the documents looks for
BLANK = " \t\n\v\f\r"
_BLANK_TABLE = {ord(blank): " " for blank in BLANK}

LEAKS = "doc_id bigint, item_id bigint, distance int, start bigint, end bigint"


def lowered(text: str) -> str:
    """A-Z in lower case; as many characters as before."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def normalised(text: str) -> str:
    """Lower case, with one space for every run of blanks and none at the ends."""
    return " ".join(part for part in lowered(text).translate(_BLANK_TABLE).split(" ") if part)


def positions(text: str) -> list[int]:
    """Place in the text of every character of its normal form."""
    places, gap = [], None
    for at, char in enumerate(text):
        if char in BLANK:
            gap = at if gap is None else gap
        else:
            if gap is not None and places:
                places.append(gap)
            gap = None
            places.append(at)
    return places


def budget_of(item: str) -> int:
    """Edits with which the item may occur."""
    return len(item) // CHARS_PER_EDIT if len(item) >= MIN_CHARS else 0


def in_whole_words(text: str, start: int, end: int) -> bool:
    """Whether a part of the text neither begins nor ends within a word."""
    inside = (text[at - 1:at + 1] for at in (start, end) if 0 < at < len(text))
    return not any(pair.isalnum() for pair in inside)


def pieces(item: str) -> list[tuple[int, str]]:
    """The item cut into its edit budget plus one pieces, each with its place."""
    count = budget_of(item) + 1
    bounds = [len(item) * i // count for i in range(count + 1)]
    return [(low, item[low:high]) for low, high in zip(bounds, bounds[1:], strict=False)]


def best_match(item: str, text: str, budget: int) -> tuple[int, int] | None:
    """Least edit distance of the item to a part of the text, and where the first such part ends.

    Myers' bit vectors: one integer holds the vertical differences of a whole column.
    """
    size = len(item)
    masks: dict[str, int] = {}
    for at, char in enumerate(item):
        masks[char] = masks.get(char, 0) | 1 << at
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    best = None
    for at, char in enumerate(text):
        match = masks.get(char, 0)
        diagonal = (((match & plus) + plus) ^ plus) | match | minus
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        score += (up & top != 0) - (down & top != 0)
        up, down = up << 1 & full, down << 1 & full
        plus = (down | ~(diagonal | up)) & full
        minus = up & diagonal
        if score <= budget and (best is None or score < best[0]):
            best = (score, at + 1)
            if not score:
                break
    return best


def match_start(item: str, text: str, end: int) -> int:
    """Start of the shortest best match that ends there: the item backwards from the end."""
    found = best_match(item[::-1], text[:end][::-1], len(item))
    return end - found[1] if found else 0


def automaton_of(items: list[tuple[int, str]]) -> ahocorasick.Automaton:
    owners: dict[str, list[tuple[int, int]]] = {}
    for index, (_, item) in enumerate(items):
        for at, piece in pieces(item):
            owners.setdefault(piece, []).append((index, at))
    automaton = ahocorasick.Automaton()
    for piece, places in owners.items():
        automaton.add_word(piece, (len(piece), places))
    automaton.make_automaton()
    return automaton


def leaks_in(text: str, items: list[tuple[int, str]], automaton: ahocorasick.Automaton) -> Iterator[tuple[int, int, int, int]]:
    """``item_id, distance, start, end`` of the best match of every item found in the text."""
    plain = normalised(text)
    tried: dict[int, set[int]] = {}
    best: dict[int, tuple[int, int, int]] = {}
    for last, (length, places) in automaton.iter(plain):
        for index, at in places:
            item = items[index][1]
            budget = budget_of(item)
            start = last + 1 - length - at
            if len(item) < MIN_CHARS:
                if index not in best and in_whole_words(plain, start, last + 1):
                    best[index] = (0, start, last + 1)
                continue
            zone = start // (budget + 1)
            if zone in tried.setdefault(index, set()) or index in best and not best[index][0]:
                continue
            tried[index].add(zone)
            low = max(0, zone * (budget + 1) - budget)
            high = (zone + 1) * (budget + 1) + len(item) + budget
            found = best_match(item, plain[low:high], budget)
            if found and (index not in best or found[0] < best[index][0]):
                end = low + found[1]
                begin = max(0, end - len(item) - budget)
                best[index] = (found[0], begin + match_start(item, plain[begin:end], end - begin), end)
    if best:
        places_in_text = positions(text)
        for index in sorted(best):
            distance, start, end = best[index]
            yield items[index][0], distance, places_in_text[start], places_in_text[end - 1] + 1


def item_passes(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items in normal form, as many at once as PASS_CHARS allows; null and blank ones are left out."""
    sized = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where(F.length("text") > 0)
    total = sized.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = max(1, math.ceil(total / PASS_CHARS))
    for number in range(passes):
        part = sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == number)
        items = sorted(((row["item_id"], normalised(row["text"])) for row in part.toLocalIterator()),
                       key=lambda item: (item[0] is not None, item[0] or 0, item[1]))
        if items := [item for item in items if item[1]]:
            yield items


def _leaks_of(docs: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(shared.value)
        for batch in batches:
            rows = [(doc_id, *leak) for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                    if text for leak in leaks_in(text, shared.value, automaton)]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([row[at] for row in rows], kind) for at, kind in enumerate(kinds)],
                                             ["doc_id", "item_id", "distance", "start", "end"])
    return docs.select("doc_id", "text").mapInArrow(over, LEAKS)


def benchmark_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every document and benchmark item of which it holds a match within the item's edit budget.

    Texts are compared in lower case (A-Z) with blanks collapsed. ``distance`` is that of the item's best match,
    the first of equals; ``start`` and ``end`` are its code points in the text. ``docs`` has ``doc_id`` and
    ``text``, ``benchmark`` has ``item_id`` and ``text``. Null and empty texts hold nothing; items under MIN_CHARS
    characters are found in whole words and without edits only, with distance 0; null and blank items are in no document. Repeated items and rows are all reported; a null doc_id stays null.
    An empty table on either side gives no rows. A benchmark beyond PASS_CHARS is looked for in several passes.
    """
    Workspace(docs.sparkSession, "leaks")
    found = docs.sparkSession.createDataFrame([], LEAKS)
    for items in item_passes(benchmark):
        found = found.unionByName(_leaks_of(docs, items))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no benchmark item; see ``benchmark_leaks``."""
    Workspace(docs.sparkSession, "leaks")
    for items in item_passes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def over(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            automaton = automaton_of(shared.value)
            for batch in batches:
                clean = [not text or next(leaks_in(text, shared.value, automaton), None) is None for text in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))
        docs = docs.mapInArrow(over, docs.schema)
    return docs
