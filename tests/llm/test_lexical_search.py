import math
import re
from collections import Counter

import pytest

from ledgerloom.llm.lexical_search import ranked_search
from ledgerloom.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {code: code + 32 for code in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, best=20):
    """All scores of all documents, sorted."""
    found = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    found = [(doc_id, count) for doc_id, count in found if count]
    number, total = len(found), sum(sum(count.values()) for _, count in found)
    holders = Counter(term for _, count in found for term in count)
    expected = []
    for item_id, text in items:
        asked, scores = Counter(terms(text)), []
        for doc_id, count in found:
            m = 100 - 25 + (25 * sum(count.values()) * number) // total
            score = sum(times * math.floor(1000 * math.log((2 * number + 2) / (2 * holders[term] + 1)))
                        * (1000000000 * count[term] // (1000 * count[term] + 12 * m)) for term, times in asked.items() if count[term])
            if score > 0:
                scores.append((score, doc_id))
        scores.sort(key=lambda one: (-one[0], one[1] is None, one[1] or 0))
        expected += [(item_id, rank, doc_id, score) for rank, (score, doc_id) in enumerate(scores[:best], 1)]
    return sorted(expected, key=str)


def found(rows):
    return sorted((tuple(row) for row in rows.collect()), key=str)


def items(spark, texts, ids=None):
    rows = [(item_id, text, "x", 1, "t") for item_id, text in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(rows, "item_id long, text string, node string, share int, term string")


def test_query_equals_brute_force(spark, documents):
    sf_dir = "/root/testdata/sf0.001"
    asked = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    expected = brute([tuple(row) for row in documents.select("doc_id", "text").collect()], [tuple(row) for row in asked.select("item_id", "text").collect()])
    assert found(QUERIES["op13_ranked_search"](spark, sf_dir)) == expected


@pytest.mark.parametrize("best", [1, 3, 20])
def test_edges_equal_brute_force(spark, docs, best):
    texts = [None, "", " .,!", "Été été ÉTÉ a-b A_b", "a b c", "a b c", "c b a", "tie one", "tie two", "x" * 40, "a " * 5000 + "rare",
             "the " * 30 + "end", "the end", "日本 語", *(f"the word{i % 7} word{i}" for i in range(60))]
    ids = [5, 6, 7, 8, 9, 9, None, 3, 2, *range(20, 20 + len(texts) - 9)]
    wanted = ["a b", "tie", None, "", "nothing here is found", "Été", "the the word3", "the", "rare 日本 word5 word12 the end", "a b",
              " ".join(f"word{i}" for i in range(60)) + " " + " ".join(f"z{i}" for i in range(200)) + " the word3"]
    names = [0, 1, 2, 3, 4, 5, 6, None, 8, 0, 10]
    rows = ranked_search(docs(texts, ids), items(spark, wanted, names), best)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(rows) == brute(list(zip(ids, texts, strict=True)), list(zip(names, wanted, strict=True)), best)


def test_very_long_words_and_texts(spark, docs):
    texts = ["q" * (1 << 20) + " w", "w " + "q" * (1 << 20), "w." * 700_000, "v,w"]
    wanted = ["q" * (1 << 20), "w", "v"]
    assert found(ranked_search(docs(texts), items(spark, wanted))) == brute(list(enumerate(texts)), list(enumerate(wanted)))


def test_empty_tables(spark, docs):
    for texts, wanted in (([], ["a"]), (["a"], []), ([], []), ([None, ""], ["a"]), (["a"], [None])):
        rows = ranked_search(docs(texts), items(spark, wanted))
        assert rows.columns == ["item_id", "rank", "doc_id", "score"] and rows.count() == 0
