"""Token ids of whole texts by the public tokenizer files, with caches of their parts.

Byte-level BPE cuts a text by a pattern in which a space can only lead a piece or be among other
blanks. So where no two blanks stand together, the parts between single spaces (each with its space)
have ids of their own, and each different part is encoded once. A part of Latin letters is cut by the same pattern into
pieces, and each different piece is given to the library's model; any other part is given to the
library. So is, whole, any other text and any that holds a special string.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache
from pathlib import Path

import numpy as np
import regex

from ledgerloom.llm._memory import remembered

CACHE_PARTS, CACHE_PIECES = 200_000, 700_000  # remembered by a worker
_BLANKS = re.compile(r"\s\s")
# The pattern of byte-level BPE, and the characters it uses for bytes.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = {byte: byte for byte in _SHOWN} | {
    byte: 0x100 + at for at, byte in enumerate(byte for byte in range(256) if byte not in set(_SHOWN))}
_LATIN_END = "\u0250"  # letters and digits below are the same in all versions of the character database


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file and its library's version."""
    if path.endswith(".model"):
        from sentencepiece import __version__
    else:
        from tokenizers import __version__
    return hashlib.sha256(Path(path).read_bytes() + __version__.encode()).hexdigest()


class _Parts(dict):
    """Value of each part of a text; a new part is encoded once."""

    def __init__(self, encode, lead: str, most: int):
        super().__init__()
        self._encode, self._lead, self._most, self._left_out = encode, lead, most, 0

    def __missing__(self, part: str):
        value = self._encode(self._lead + part)
        if len(self) < self._most:
            self[part] = value
            return value
        # frequent parts came early and stay; after many others the cache starts anew, as texts may have changed
        self._left_out += 1
        if self._left_out > 8 * self._most:
            self.clear()
            self._left_out = 0
        return value


class Encoder:
    """Ids or counts of texts by a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file.

    No begin, end or other special tokens are added; special strings inside a text are read as the library
    reads them by default; nothing is cut or padded.
    """

    def __init__(self, path: str, counts_only: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._wrap = len if counts_only else self._packed
        self._counts = counts_only
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.size, self._whole, self._special, chunked = model.get_piece_size(), model.encode, None, False
        else:
            from tokenizers import Tokenizer
            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.size = model.get_vocab_size()
            self._whole = lambda text: model.encode(text, add_special_tokens=False).ids
            words = [re.escape(token.content) for token in model.get_added_tokens_decoder().values()]
            self._special = re.compile("|".join(words)) if words else None
            shape = json.loads(model.to_str())
            chunked = (shape["normalizer"] is None and shape["model"]["type"] == "BPE"
                       and (shape["pre_tokenizer"] or {}).get("type") == "ByteLevel"
                       and shape["pre_tokenizer"]["use_regex"] and not shape["pre_tokenizer"]["add_prefix_space"])
        self.width = 2 if self.size <= 1 << 16 else 4
        self._first, self._rest = (_Parts(self._part, lead, CACHE_PARTS) for lead in ("", " ")) if chunked else (None, None)
        if chunked:
            bpe = model.model
            self._pieces = _Parts(lambda piece: self._wrap([token.id for token in bpe.tokenize(
                piece.encode().decode("latin-1").translate(_BYTE_CHARS))]), "", CACHE_PIECES)

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, f"<u{self.width}").tobytes()

    def _value(self, text: str):
        return self._wrap(self._whole(text))

    def _part(self, part: str):
        """The value of a part between spaces, by its pieces where all its characters are plain."""
        if max(part) >= _LATIN_END or not part.replace("\n", "").isprintable():
            return self._value(part)
        values = map(self._pieces.__getitem__, PIECES.findall(part))
        return sum(values) if self._counts else b"".join(values)

    def __call__(self, text: str):
        """The number of ids, or the ids as little-endian bytes of ``width`` each."""
        if self._rest is None or _BLANKS.search(text) or self._special and self._special.search(text):
            return self._value(text)
        first, *rest = text.split(" ")
        values = map(self._rest.__getitem__, rest)
        if self._counts:
            return (self._first[first] if first else 0) + sum(values)
        return (self._first[first] if first else b"") + b"".join(values)


@remembered
@lru_cache(maxsize=1)
def shared_encoder(path: str, counts_only: bool = False) -> Encoder:
    """The encoder of a worker process, whose caches serve its tasks one after the other."""
    return Encoder(path, counts_only)
