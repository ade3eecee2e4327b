import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm.byte_bpe import Codec, decoded, encoded, round_trip_digest, unmade_tokens
from tests.llm.texts import TOKEN_TEXTS

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def codec():
    return Codec(PATH, PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("library", pat_str=PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


PARTS = st.sampled_from(["a", "b", "ab", "the", "ing", " ", "  ", "\n", "é", "テ", "1", "!", "'s", "aaaa", "\x00", "　", "<|endoftext|>",
                         "՘", "\U000323b0", "\U00011de0", "࢏", "꟱", "Straße", "ñ"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(PARTS, st.text(max_size=4)), max_size=30))
def test_ids_equal_the_library(codec, library, parts):
    text = "".join(parts).encode("utf-8", "replace").decode()
    ids = codec.encode(text)
    assert list(ids) == library.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_random_words_equal_the_library(codec, library):
    spread = random.Random(3)
    for size in [*range(1, 60), 3000]:
        for letters in ("ab", "abcdefghijklmnopqrstuvwxyz", "aéñоé"):
            text = "".join(spread.choice(letters) for _ in range(size))
            assert list(codec.encode(text)) == library.encode_ordinary(text)


def test_characters_newer_or_older_than_the_library_follow_it(codec, library):
    text = "".join(chr(code) + ("a" if code % 2 else " 1") for code in range(0x110000) if not 0xD800 <= code < 0xE000 and code % 7 == 0)
    assert list(codec.encode(text)) == library.encode_ordinary(text)


def test_long_pieces_take_time_in_proportion(codec):
    import time

    def seconds(size):
        start = time.perf_counter()
        codec.piece_ids(b"ab" * size)
        return time.perf_counter() - start
    seconds(1000)
    assert seconds(200_000) < 40 * seconds(20_000)


def test_tokens_without_merges_stand_for_whole_pieces_only(tmp_path):
    import base64
    ranks = {bytes([byte]): byte for byte in range(256)} | {b"ab": 256, b"xyz": 257, b"abc": 258}
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(token) + b" %d" % rank for token, rank in ranks.items()))
    unmade = unmade_tokens(str(path))
    assert unmade == {257}
    own, library = Codec(str(path), PATTERN, unmade), tiktoken.Encoding("x", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("xyz", "xyzz", "abcab", "aabcxyz", " xyz"):
        assert list(own.encode(text)) == library.encode_ordinary(text)


def test_rows(spark, docs, library):
    texts = [*TOKEN_TEXTS, "hello world"]
    ids = [None, 1, 1, *range(3, len(texts))]
    rows = sorted(encoded(docs(texts, ids), PATH, PATTERN).collect(), key=str)
    assert rows == sorted([(doc_id, library.encode_ordinary(text or "")) for doc_id, text in zip(ids, texts, strict=True)], key=str)
    back = decoded(encoded(docs(texts, ids), PATH, PATTERN), PATH)
    assert sorted((bytes(row["bytes"]) for row in back.collect())) == sorted((text or "").encode() for text in texts)
    assert round_trip_digest(docs([]), PATH, PATTERN).count() == 0


def test_query_equals_the_library(spark, documents, library):
    from ledgerloom.llm.queries import QUERIES
    found = {tuple(row) for row in QUERIES["op12_byte_bpe"](spark, "/root/testdata/sf0.001").collect()}
    expected = set()
    for row in documents.select("doc_id", "text").collect():
        text = row["text"] or ""
        ids = library.encode_ordinary(text)
        expected.add((row["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                      hashlib.sha256(text.encode()).hexdigest()))
    assert found == expected
