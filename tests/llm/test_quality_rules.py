import math
from collections import Counter

import pytest

from ledgerloom.llm.quality_rules import duplicate_lines, quality_rules
from llm.texts import long_text


def brute(text):
    words = (text or "").encode().split()
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines, seen, again = (text or "").split("\n"), set(), 0
    for line in lines:
        if line.encode().split():
            again += line in seen
            seen.add(line)
    return (len(words), sum(len(word.decode()) for word in words), sum(char in "#*$%&|<>" for char in text or ""), again, len(covered))


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_counts_match_brute_force(spark, docs, documents):
    texts = [None, "", " \n\t", "a b c a b c", "x\nx\n x\nx", "ä$ ö|<> z", "é " * 60, long_text(), "a b c d " * 40]
    for frame in (docs(texts), documents):
        for row in quality_rules(frame, labels(spark, []), ["doc_id", "text"]).collect():
            assert tuple(row[name] for name in NAMES) == brute(row["text"])
            failed = row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"]
            assert row["base_failed"] == failed and row["kept"] == (not failed) and row["llr"] == 0


def test_held_out_labels(spark):
    """Fitted on half of the labelled documents, the rules tell the other half's good from its bad."""
    folder = "/root/testdata/sf0.01"
    known = spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality_rules(spark.read.parquet(f"{folder}/documents.parquet"), known.where("doc_id % 2 = 0"))
    judged = rows.join(known.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").select("quality", "kept").collect()
    good = [row["kept"] for row in judged if row["quality"] == 1]
    bad = [row["kept"] for row in judged if row["quality"] == 0]
    assert len(good) > 100 and sum(good) == len(good)
    assert len(bad) > 10 and not any(bad)


def test_ratio_is_the_mean_of_the_log_ratios(spark, docs):
    good, bad = "alpha beta " * 3000, "gamma delta " * 3000
    rows = {row["doc_id"]: row["llr"] for row in quality_rules(docs([good, bad, good, bad]), labels(spark, [(0, 1, 0), (1, 0, 0)])).collect()}
    assert rows[0] == rows[2] > 0 > rows[1] == rows[3]
    buckets = 2 << 12
    # alpha: 3000 of 11999 trusted n-grams, 6000 of 47996 in all
    expected = math.log((3000 + 1) / (11999 + buckets)) - math.log((6000 + 1) / (47996 + buckets))
    assert rows[0] == pytest.approx(expected, abs=0.02)


def test_ids_repeat_and_are_null(spark, docs):
    frame = docs(["a", "b b", "c c c", "d"], [1, 1, None, None])
    rows = quality_rules(frame, labels(spark, [(1, 1, 0), (1, 0, 0), (None, 1, None)])).collect()
    assert sorted((str(row["doc_id"]), row["n_words"]) for row in rows) == [("1", 1), ("1", 2), ("None", 1), ("None", 3)]


def test_empty_tables(spark, docs):
    assert quality_rules(docs([]), labels(spark, [])).count() == 0


def test_duplicate_lines_counts_exact_lines():
    assert duplicate_lines(b"a\n a\na\n\n\n \n \na") == 2
