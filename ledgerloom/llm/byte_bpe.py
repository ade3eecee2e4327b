"""Byte-level BPE by rank files: longest matches with backtracking, and back to bytes.

The bytes of a piece are read as Latin-1 characters, so one automaton over all tokens finds the longest token
at every place of a piece. Encoding goes on with the longest token that the one before it tolerates, tries
shorter prefixes of it otherwise, and steps back where none is left. Two neighbours tolerate each other if
merging by rank leaves the border between them alone; a sequence all of whose neighbours do is the one the merges
give, and as it is the only one for its bytes, a place given up once is never tried again, so
time grows in proportion to the piece.

Both directions treat every row by itself: null ids and repeated rows stay as they are, null and empty texts have no
ids, texts of any length are taken whole (long ones piece by piece), an empty table gives an empty one, and columns
besides those named are ignored, whatever their names.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import batched

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm._frames import map_arrow
from ledgerloom.llm._memory import remembered
from ledgerloom.llm._words import as_bytes

CACHE_PIECES, CACHE_LENGTH = 125_000, 64  # pieces a worker remembers per generation, and the characters of the longest of them
CACHE_PAIRS = 500_000
ROWS = 500  # rows of a batch worked on at once
LONG_TEXT, PIECES = 1 << 20, 1 << 15  # longer texts are cut into so many pieces at a time
_NEVER = 1 << 62
# one character of each class of the pattern, and a character before it with which it makes one piece
_CLASSES = {"letter": ("a", "a"), "number": ("1", "1"), "other": ("!", "!"), "blank": ("　", "")}


class _Bounded(dict):
    """A memo of ``function`` that starts anew when it holds ``most`` values."""

    def __init__(self, function, most: int):
        super().__init__()
        self._function, self._most = function, most

    def __missing__(self, key):
        value = self._function(key)
        if len(self) >= self._most:
            self.clear()
        self[key] = value
        return value


class _PieceIds(dict):
    """The ids of pieces, packed; short ones are remembered, in two generations of which the older one is dropped."""

    def __init__(self, function):
        super().__init__()
        self._function, self._older = function, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self._older.get(piece)
        if packed is None:
            packed = array("i", self._function(piece.encode())).tobytes()
        if len(piece) <= CACHE_LENGTH:
            if len(self) >= CACHE_PIECES:
                self._older = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class Splitter:
    """The pieces of a text by a pattern, with the character classes that tiktoken's expressions have.

    That library and ``regex`` may follow different versions of the character database. A character whose
    class differs is matched as another character of the library's class.
    """

    def __init__(self, pattern: str):
        import tiktoken
        self._found = regex.compile(pattern)
        marks = [probe + bytes([lead]) for probe in (b"a", b"1", b"!") for lead in range(128, 256)]
        self._probe = tiktoken.Encoding("classes", pat_str=r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|\s+", special_tokens={},
                                        mergeable_ranks={bytes([i]): i for i in range(256)} | {
                                            mark: 256 + at for at, mark in enumerate(marks)})
        self._own = {name: regex.compile(one) for name, one in
                     {"letter": r"\p{L}", "number": r"\p{N}", "blank": r"\s", "other": r"[^\s\p{L}\p{N}]"}.items()}
        self._agreed, self._other = {chr(code) for code in range(0x80)}, {}

    def library_class(self, char: str) -> str:
        for name in ("letter", "number", "other"):
            if self._probe.encode_ordinary(_CLASSES[name][1] + char)[0] >= 256:
                return name
        return "blank"

    def _look(self, chars: set[str]) -> None:
        for char in chars:
            name = self.library_class(char)
            if self._own[name].match(char):
                self._agreed.add(char)
            else:
                self._other[ord(char)] = _CLASSES[name][0]

    def __call__(self, text: str) -> Iterator[list[str]]:
        """Lists of pieces that together are the text."""
        seen = text
        if not text.isascii():
            new = set(text) - self._agreed
            if new:
                self._look(new)
                seen = text.translate(self._other)
        if seen is text and len(text) <= LONG_TEXT:
            yield self._found.findall(text)
        else:
            for matches in batched(self._found.finditer(seen), PIECES):
                yield [text[match.start():match.end()] for match in matches]


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Codec:
    """Ids of texts and bytes of ids by a file of ranks (a token in base 64 and its rank per line).

    ``unmade`` names tokens that no merges make, as ``unmade_tokens`` finds them; they stand for whole pieces only.
    """

    def __init__(self, path: str, pattern: str, unmade: frozenset[int] = frozenset()):
        self.ranks = _ranks(path)
        missing = [byte for byte in range(256) if bytes([byte]) not in self.ranks]
        if missing:
            raise ValueError(f"the ranks lack the bytes {missing[:5]}")
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self._split = Splitter(pattern)
        self._automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            if rank not in unmade:
                self._automaton.add_word(token.decode("latin-1"), rank)
        self._automaton.make_automaton()
        self._most = max(map(len, self.ranks))
        self._halves, self._shorter, self._unmade = {}, {}, unmade
        self._fits = _Bounded(self._tolerates, CACHE_PAIRS)
        self._ids = _PieceIds(self.piece_ids)

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; none for a byte, or if merges by rank never make it."""
        if token not in self._halves:
            whole = self.bytes_of[token]
            parts = [whole[at:at + 1] for at in range(len(whole))]
            while len(parts) > 2:
                rank, at = min((self.ranks.get(a + b, _NEVER), at) for at, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                if rank == _NEVER:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            pair = tuple(self.ranks[part] for part in parts) if len(parts) == 2 else None
            if pair and max(pair) >= token:
                raise ValueError(f"token {token} ranks before its parts {pair}")
            self._halves[token] = pair
        return self._halves[token]

    def _edge(self, token: int, side: int) -> list[int]:
        """What stands at one end of a token while it is being merged: a byte first, the token last."""
        found = [token]
        while pair := self.halves(token):
            token = pair[side]
            found.append(token)
        return found[::-1]

    def _tolerates(self, pair: tuple[int, int]) -> bool:
        """Whether merging by rank never crosses the border between two neighbours."""
        left, right = self._edge(pair[0], 1), self._edge(pair[1], 0)
        i = j = 0
        while True:
            grown_left = left[i + 1] if i + 1 < len(left) else _NEVER
            grown_right = right[j + 1] if j + 1 < len(right) else _NEVER
            across = self.ranks.get(self.bytes_of[left[i]] + self.bytes_of[right[j]], _NEVER)
            if across < grown_left and across <= grown_right and across != _NEVER:  # of equal ranks the leftmost pair merges first
                return False
            if grown_left == grown_right == _NEVER:
                return True
            if grown_left <= grown_right:
                i += 1
            else:
                j += 1

    def _next_shorter(self, token: int) -> int:
        """The longest token that is a shorter prefix of this one and that merges make; -1 if there is none."""
        if token not in self._shorter:
            whole = self.bytes_of[token]
            prefixes = (self.ranks.get(whole[:size], -1) for size in range(len(whole) - 1, 0, -1))
            self._shorter[token] = next((rank for rank in prefixes if rank >= 0 and rank not in self._unmade), -1)
        return self._shorter[token]

    def piece_ids(self, piece: bytes) -> list[int]:
        """The ids that merging by rank gives."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        text, fits, bytes_of = piece.decode("latin-1"), self._fits, self.bytes_of
        ids, at, given_up = [], 0, set()
        longest, seen_to = None, 0  # longest tokens from here on, over the text up to a place
        while True:
            if longest is None or at + self._most > seen_to < len(text):
                seen_to = min(at + 8 * self._most, len(text))
                longest = self._automaton.iter_long(text[at:seen_to])
            _, token = next(longest)
            while True:
                end = at + len(bytes_of[token])
                if end not in given_up and (not ids or fits[ids[-1], token]):
                    break
                longest = None  # the next place is another one than the end of the longest token
                token = self._next_shorter(token)
                while token < 0:
                    given_up.add(at)
                    last = ids.pop()
                    at -= len(bytes_of[last])
                    token = self._next_shorter(last)
            ids.append(token)
            at = end
            if at == len(text):
                return ids

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join([b"".join(map(self._ids.__getitem__, pieces)) for pieces in self._split(text)]), np.int32)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@remembered
@lru_cache(maxsize=1)
def shared_codec(path: str, pattern: str, unmade: frozenset[int]) -> Codec:
    """The codec of a worker process, whose memos serve its tasks one after the other."""
    return Codec(path, pattern, unmade)


@remembered
@lru_cache(maxsize=1)
def shared_tokens(path: str) -> dict[int, bytes]:
    """The bytes of each id, which is all that decoding needs."""
    return {rank: token for token, rank in _ranks(path).items()}


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for low in range(0, batch.num_rows, ROWS):
        yield batch.slice(low, ROWS)


@lru_cache(maxsize=8)
def unmade_tokens(path: str) -> frozenset[int]:
    """Tokens of a file of ranks that no merges make; an error if a token ranks before its parts."""
    codec = Codec(path, r"[\s\S]+")
    return frozenset(rank for rank, token in codec.bytes_of.items() if len(token) > 1 and codec.halves(rank) is None)


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` of every row of ``docs``, from the whole ``text``.

    ``path`` is a file of ranks that every executor has. Each match of ``pattern`` is encoded by itself;
    strings of special tokens are ordinary text. Bytes that are no UTF-8 are read as U+FFFD.
    """
    unmade = unmade_tokens(path)

    def over(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        codec = shared_codec(path, pattern, unmade)
        for part in _parts(batch):
            ids = [codec.encode(text.decode("utf-8", "replace")) for text in as_bytes(part.column("text"))]
            ends = np.cumsum([0, *map(len, ids)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return map_arrow(rows, over, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, bytes``: the ids of every row and the bytes they stand for; null ids stand for none."""
    def over(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bytes_of = shared_tokens(path).__getitem__
        for part in _parts(batch):
            lists = part.column("ids").fill_null([])
            values, ends = lists.flatten().to_numpy().tolist(), np.cumsum(lists.value_lengths().to_numpy()).tolist()
            texts = [b"".join(map(bytes_of, values[low:high])) for low, high in zip([0, *ends], ends, strict=False)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(texts, pa.binary())],
                                             ["doc_id", "ids", "bytes"])

    kept = rows.select("doc_id", "ids")
    return map_arrow(kept, over, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, bytes binary")


def round_trip_digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row of ``docs`` its id, number of token ids, and SHA-256 of the ids in decimal and of the decoded bytes."""
    return decoded(encoded(docs, path, pattern), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))
