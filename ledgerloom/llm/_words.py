"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes other than space and the five ASCII control blanks, so UTF-8 text can be
split as bytes. Words are hashed by a random table per byte value and powers of an odd number,
modulo 2**64, then mixed; all words of a slice of about a megabyte take a few array passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import xxhash

BLANKS = b" \t\n\v\f\r"
SLICE = 1 << 20  # bytes hashed at once; a longer word is hashed by itself

_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(33)
_ODD = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(20240229).integers(1, 2**64 - 1, 256, np.uint64) | np.uint64(1)


def _powers(base: int) -> np.ndarray:
    steps = np.full(SLICE + 1, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


_POWER, _INVERSE = _powers(_ODD), _powers(pow(_ODD, -1, 2**64))

#: Classes of bytes: 0 separates tokens, a change between the others also does.
WORD_CLASSES = np.ones(256, np.uint8)
WORD_CLASSES[list(BLANKS)] = 0

#: Letters, digits and bytes of other scripts are 1, punctuation is 2.
TOKEN_CLASSES = np.full(256, 2, np.uint8)
TOKEN_CLASSES[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = 1
TOKEN_CLASSES[[*range(0, 33), 127]] = 0


class Hashes(NamedTuple):
    """Token hashes of texts ``first``.. of a batch; text ``i`` of them has ``values[offsets[i]:offsets[i + 1]]``."""

    first: int
    values: np.ndarray
    offsets: np.ndarray


def mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> _SHIFT)) * _MIX1
    value = (value ^ (value >> _SHIFT)) * _MIX2
    return value ^ (value >> _SHIFT)


def _slice_hashes(data: bytes, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start positions of the tokens of at most SLICE bytes."""
    codes = np.frombuffer(data, np.uint8)
    kinds = np.zeros(len(codes) + 2, np.uint8)
    kinds[1:-1] = classes[codes]
    edges = np.flatnonzero(kinds[1:] != kinds[:-1])
    starts = edges[kinds[edges + 1] != 0]
    ends = edges[kinds[edges] != 0]
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_TABLE[codes] * _POWER[:len(codes)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _INVERSE[starts]), starts


def _parts(text: bytes) -> Iterator[bytes]:
    """The text cut at blanks into parts of at most SLICE bytes, unless one word is longer."""
    low = 0
    while len(text) - low > SLICE:
        high = max(text.rfind(blank, low + 1, low + SLICE) for blank in BLANKS)
        if high < 0:
            found = [at for at in (text.find(blank, low + 1) for blank in BLANKS) if at > 0]
            high = min(found, default=len(text))
        yield text[low:high]
        low = high
    yield text[low:]


def _long_text(text: bytes, classes: np.ndarray) -> np.ndarray:
    values = []
    for part in _parts(text):
        if len(part.strip(BLANKS)) > SLICE:
            values.append(np.array([xxhash.xxh3_64_intdigest(part.strip(BLANKS))], np.uint64))
        else:
            values.append(_slice_hashes(part, classes)[0])
    return np.concatenate(values)


def token_hashes(texts: list[bytes], classes: np.ndarray = WORD_CLASSES) -> Iterator[Hashes]:
    """Token hashes of all texts, in groups of neighbours."""
    first = 0
    while first < len(texts):
        size, last = len(texts[first]) + 1, first + 1
        if size > SLICE:
            values = _long_text(texts[first], classes)
            yield Hashes(first, values, np.array([0, len(values)]))
        else:
            while last < len(texts) and size + len(texts[last]) + 1 <= SLICE:
                size += len(texts[last]) + 1
                last += 1
            values, starts = _slice_hashes(b"\n".join(texts[first:last]), classes)
            bounds = np.cumsum([0, *(len(text) + 1 for text in texts[first:last])])
            yield Hashes(first, values, np.searchsorted(starts, bounds))
        first = last


_PLACES = mixed(np.arange(1, 6, dtype=np.uint64)) | np.uint64(1)


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` neighbouring tokens; window ``i`` starts at token ``i``."""
    count = max(0, len(values) - size + 1)
    total = np.zeros(count, np.uint64)
    for place in range(size):
        total += values[place:place + count] * _PLACES[place]
    return mixed(total)


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values, as ``np.unique`` gives them, at a fraction of its cost per small array."""
    ordered = np.sort(values)
    keep = np.empty(len(ordered), bool)
    keep[:1] = True
    np.not_equal(ordered[1:], ordered[:-1], out=keep[1:])
    return ordered[keep]


def shingle_sets(texts: list[bytes], size: int = 5) -> Iterator[np.ndarray]:
    """Per text its sorted distinct shingles; fewer words than ``size`` make one shingle, none make none."""
    for group in token_hashes(texts):
        windows = window_hashes(group.values, size)
        for low, high in zip(group.offsets[:-1], group.offsets[1:], strict=True):
            if high - low >= size:
                yield _distinct(windows[low:high - size + 1])
            elif high > low:
                yield window_hashes(group.values[low:high], high - low) ^ np.uint64(high - low)
            else:
                yield np.zeros(0, np.uint64)


def as_bytes(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes, null as empty."""
    return [value or b"" for value in column.cast("binary").to_pylist()]
