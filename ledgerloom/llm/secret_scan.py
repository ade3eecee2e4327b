"""Secret scans: keyword automaton, anchored expressions at its hits, checksums of the tokens that carry one.

One Aho-Corasick pass over the lower-cased text finds every place where a secret may begin; only there
the expression of its kind is tried, anchored. Long hexadecimal runs have no keyword and are found
by their own expression. Tokens of code hosts end in six base-62 digits of a CRC-32 over the rest;
one that fails it is no token.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm._frames import Workspace, map_arrow
from ledgerloom.llm.decontaminate import lowered

ASSIGN = re.compile(r"""(?:(?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
HOST_TOKEN = re.compile(r"(?:gh[oprsu]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
MIN_ASSIGNED, MIN_ACCESS = 6, 20
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "host_token": ("gho_", "ghp_", "ghr_", "ghs_", "ghu_", "npm_"),
}
KINDS = ("assign", "access", "hex", "host_token")
BASE_KINDS = KINDS[:3]
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

ROWS = "doc_id bigint, kinds array<string>, starts array<bigint>, ends array<bigint>"


class Span(NamedTuple):
    start: int
    order: int
    end: int

    @property
    def text(self) -> str:
        return f"{KINDS[self.order]}:{self.start}:{self.end}"


def checksum(body: str) -> str:
    """CRC-32 of the body as six base-62 digits."""
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits.rjust(6, "0")


def _assigned(match: re.Match) -> bool:
    return len(match[1]) >= MIN_ASSIGNED


def _accessed(match: re.Match) -> bool:
    return len(match[0]) >= MIN_ACCESS


def _checked(match: re.Match) -> bool:
    return checksum(match[1]) == match[2]


RULES = {"assign": (ASSIGN, _assigned), "access": (ACCESS, _accessed), "host_token": (HOST_TOKEN, _checked)}


def keyword_automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def secrets_in(text: str, automaton: ahocorasick.Automaton) -> list[Span]:
    """Spans of all kinds in order of start, then kind; those of one kind do not overlap.

    A match that fails its length or checksum still uses up its characters, as in one search from left to right.
    """
    spans = []
    done = dict.fromkeys(RULES, 0)
    starts = {(last + 1 - length, kind) for last, (kind, length) in automaton.iter(lowered(text))}
    for start, kind in sorted(starts):
        expression, valid = RULES[kind]
        if start < done[kind]:
            continue
        if match := expression.match(text, start):
            done[kind] = match.end()
            if valid(match):
                spans.append(Span(start, KINDS.index(kind), match.end()))
    spans.extend(Span(match.start(), KINDS.index("hex"), match.end()) for match in HEX.finditer(text))
    return sorted(spans)


def secret_spans(docs: DataFrame) -> DataFrame:
    """The secrets of every document: ``doc_id`` and the arrays ``kinds, starts, ends``.

    Positions are code points, the end exclusive. A null or empty text has none. Rows that repeat an id, also a null one,
    are scanned one by one. An empty table gives no rows; other columns are ignored.
    """
    Workspace(docs.sparkSession, "secrets")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = keyword_automaton()
        for batch in batches:
            found = [secrets_in(text or "", automaton) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()),
                 pa.array([[KINDS[span.order] for span in spans] for spans in found], pa.list_(pa.string())),
                 pa.array([[span.start for span in spans] for spans in found], pa.list_(pa.int64())),
                 pa.array([[span.end for span in spans] for spans in found], pa.list_(pa.int64()))],
                ["doc_id", "kinds", "starts", "ends"])
    return docs.select("doc_id", "text").mapInArrow(over, ROWS)


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts per base kind, a digest of the base spans and all spans as text, per document."""
    def digest(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts, digests, texts = {kind: [] for kind in BASE_KINDS}, [], []
        for kinds, starts, ends in zip(*(batch.column(name).to_pylist() for name in ("kinds", "starts", "ends")), strict=True):
            spans = [(kind, f"{kind}:{start}:{end}") for kind, start, end in zip(kinds, starts, ends, strict=True)]
            for kind in BASE_KINDS:
                counts[kind].append(kinds.count(kind))
            base = ",".join(text for kind, text in spans if kind in BASE_KINDS)
            digests.append(hashlib.sha256(base.encode()).hexdigest())
            texts.append(",".join(text for _, text in spans))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(counts[kind], pa.int64()) for kind in BASE_KINDS), pa.array(digests, pa.string()), pa.array(texts, pa.string())],
            ["doc_id", *(f"n_{kind}" for kind in BASE_KINDS), "base_sha256", "spans"])
    return map_arrow(secret_spans(docs), digest,
                     "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
