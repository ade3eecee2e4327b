import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import _tokenizer
from ledgerloom.llm._tokenizer import Encoder, tokenizer_version
from ledgerloom.llm.token_counts import token_counts
from llm.texts import TOKEN_TEXTS as TEXTS

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(texts, path=PATH):
    if path.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(model.encode(text or "")) for text in texts]
    tokenizer = Tokenizer.from_file(path)
    return [len(tokenizer.encode(text or "", add_special_tokens=False).ids) for text in texts]


def found(frame):
    return {row["doc_id"]: (row["n_bytes"], row["n_tokens"], row["over_limit"]) for row in frame.collect()}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_of_edge_texts(docs, name):
    path = public_tokenizers.path(name)
    rows = found(token_counts(docs(TEXTS), path))
    assert rows == {at: (len((text or "").encode()), n, n > 1024) for at, (text, n) in enumerate(zip(TEXTS, expected(TEXTS, path), strict=True))}


def test_counts_of_documents(documents):
    rows = found(token_counts(documents, PATH))
    texts = {row["doc_id"]: row["text"] for row in documents.collect()}
    assert {key: row[1] for key, row in rows.items()} == dict(zip(texts, expected(texts.values()), strict=True))


def test_blanks_and_special_strings_in_every_place():
    parts = ["a", " ", "  ", "\n", "\t", " ", "<|endoftext|>", "'s", "é!", "12", "\x1c", "　"]
    whole, count = Tokenizer.from_file(PATH), Encoder(PATH, counts_only=True)
    packed = Encoder(PATH)
    for one in [*parts, "ž", "ß²", "٣", "\xad", "\xa0"]:
        for two in parts:
            for three in parts:
                text = f"x{one}{two}{three}y {one}{two} z"
                ids = whole.encode(text, add_special_tokens=False).ids
                assert count(text) == len(ids), repr(text)
                assert packed(text) == packed._packed(ids), repr(text)


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(_tokenizer, "CACHE_PARTS", 3)
    count = Encoder(PATH, counts_only=True)
    text = " ".join(f"word{i}" for i in range(50))
    assert count(text) == expected([text])[0] and len(count._rest) <= 3


def test_only_new_texts_are_appended(spark, docs, tmp_path):
    cache = f"file://{tmp_path}/cache"
    first = found(token_counts(docs(["a b c", "d e", "a b c"]), PATH, cache))
    stored = lambda: spark.read.parquet(cache)
    assert stored().count() == 2
    again = found(token_counts(docs(["a b c", "new text", "d e"]), PATH, cache))
    assert stored().count() == 3 and again[0] == first[0] and again[2][1] == first[1][1]
    token_counts(docs(["a b c"]), public_tokenizers.path("word_bpe_49k.json"), cache)
    assert stored().count() == 4 and stored().select("tokenizer").distinct().count() == 2
    assert tokenizer_version(PATH) in {row["tokenizer"] for row in stored().collect()}


def test_null_and_repeated_ids_and_empty_table(docs):
    rows = token_counts(docs(["x", "x", None], [None, None, 4]), PATH).collect()
    assert sorted((str(row["doc_id"]), row["n_tokens"]) for row in rows) == [("4", 0), ("None", 1), ("None", 1)]
    assert token_counts(docs([]), PATH).count() == 0
