import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm._frames import Workspace
from ledgerloom.llm.binary_records import binary_records, framed, indexed, read_records, unframed, write_records
from llm.texts import TOKEN_TEXTS as TEXTS

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    """Rows (doc_id, text) in order to (doc_id, start, n_tokens, ids_crc32)."""
    tokenizer, start, result = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        result.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return result


def found(frame):
    return sorted(map(tuple, frame.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda row: row[1])


def test_records_of_edge_texts(docs):
    assert found(binary_records(docs(TEXTS[::-1], range(len(TEXTS))[::-1]), PATH)) == expected(enumerate(TEXTS))


def test_records_of_documents(documents):
    rows = sorted((row["doc_id"], row["text"]) for row in documents.collect())
    assert found(binary_records(documents, PATH)) == expected(rows)


def test_null_and_repeated_ids(docs):
    rows = found(binary_records(docs(["b", "a", "c", "a"], [5, None, 5, -3]), PATH))
    assert [row[0] for row in rows] == [None, -3, 5, 5]
    assert [row[1] for row in rows] == [0, 2, 4, 6]


def test_order_as_the_rows_lie(docs):
    rows = found(binary_records(docs(["b", "a", "c"], [3, 1, 2]).coalesce(1), PATH, by_id=False))
    assert [row[0] for row in rows] == [3, 1, 2]


def test_empty_table(docs):
    assert found(binary_records(docs([]), PATH)) == []


def test_shuffled_reads_from_the_index(spark, docs):
    work = Workspace(spark, "test")
    index = work.stage(indexed(work.stage(write_records(docs(TEXTS), PATH, f"{work.folder}/out"), "written")), "index")
    rows = found(read_records(index.orderBy("length").coalesce(1), f"{work.folder}/out"))
    assert rows == expected(enumerate(TEXTS))


def test_frames_show_damage():
    record = framed(-7, np.array([1, 2, 65535], "<u2").tobytes(), 2)
    doc_id, ids = unframed(record)
    assert doc_id == -7 and ids.tolist() == [1, 2, 65535]
    assert unframed(framed(None, b"", 4))[0] is None
    for at in range(len(record)):
        broken = bytearray(record)
        broken[at] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            unframed(bytes(broken))
    with pytest.raises(ValueError, match="damaged"):
        unframed(record[:-1])
