import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm._bits import key_filter, may_hold
from ledgerloom.llm.line_templates import signature, without_recurring_lines
from llm.texts import long_text


def found(frame, **options):
    return sorted((tuple(row) for row in without_recurring_lines(frame, **options).collect()), key=str)


def test_recurring_templates_are_dropped_and_others_stay(docs):
    names = ["ann", "bob", "cid", "dee", "eve", "fay", "gus", "hal"]
    texts = [f"{name}x {name}y {name}z\nPosted by user {name} at {at}:30 today in the forum\n{name} ends" for at, name in enumerate(names)]
    rows = found(docs(texts), least=4)
    # "Posted by user <*> at <*> today in the forum": two of eleven tokens vary
    assert rows == sorted(((at, 3, 1, "\n".join(text.split("\n")[::2])) for at, text in enumerate(texts)), key=str)


def test_few_fixed_tokens_make_no_template(docs):
    texts = [f"a b x{chr(97 + at)} y{chr(97 + at)} z{chr(97 + at)}" for at in range(6)]
    assert all(row[2] == 0 for row in found(docs(texts), least=3))
    assert all(row[2] == 1 for row in found(docs(texts), least=3, fixed=0.4))


def test_documents_count_not_lines(docs):
    texts = ["same line\n" * 9, "same line", "other"]
    assert [row[2] for row in found(docs(texts), least=3)] == [0, 0, 0]
    assert [row[2] for row in found(docs(texts), least=2)] == [9, 1, 0]


def test_edge_rows(docs):
    texts = [None, "", "\n\n", "shared line one\n\n", "shared line one", long_text(30_000) + "\nshared line one", "é\tshared"]
    rows = found(docs(texts, [0, 1, 2, 3, None, 5, 5]), least=3)
    by_text = {(row[0], row[3]): row[1:3] for row in rows}
    assert by_text[(0, None)] == (0, 0) and by_text[(1, "")] == (0, 0) and by_text[(2, "\n\n")] == (0, 0)
    assert by_text[(3, "\n")] == (1, 1) and by_text[(None, "")] == (1, 1)
    assert by_text[(5, long_text(30_000))] == (2, 1) and by_text[(5, "é\tshared")] == (1, 0)
    assert found(docs([]), least=2) == []


def test_lines_of_digits_that_repeat_word_for_word_are_dropped(docs):
    """Too many digits for a template, but the same digits in enough documents."""
    own = [f"{name}x {name}y\nPage {at} of 99" for at, name in enumerate(["ann", "bob", "cid", "dee"])]
    texts = [f"{text}\nPage 3 of 10\n2024-01-01  12:00 ERROR 42\t" for text in own] + ["2024-01-01 12:00 ERROR 43\nPage 3 of 11"]
    want = [(at, 4, 2, text) for at, text in enumerate(own)] + [(4, 2, 0, texts[4])]
    assert found(docs(texts), least=4) == sorted(want, key=str)
    assert all(row[2] == 0 for row in found(docs(texts), least=5))


def test_long_lines_recur_in_few_unrelated_documents(docs):
    """Planted lines of 50 words in 2, 3 and 9 documents, beside clean ones and near copies, which keep theirs."""
    rng = random.Random(8)

    def line(size):
        return " ".join("".join(rng.choice("abcdefghijklm") for _ in range(7)) for _ in range(size))
    planted = [(line(50), range(0, 2)), (line(50) + " 1 2 3", range(2, 5)), (line(50), range(5, 14))]
    short = line(6)  # in nine documents, as chance has it
    bodies = [f"{line(30)}\n{line(25)}" + (f"\n{short}" if at < 9 else "") for at in range(20)]
    texts = list(bodies)
    for passage, holders in planted:
        for at in holders:
            texts[at] += "\n" + passage
    copied = line(40)
    texts += [f"{copied}\n{line(3)}\n{line(60)}\n{part}" for part in ("end", "other end")]
    texts[-1] = texts[-2].replace(" ", " q ", 1)  # near copies, one word apart
    rows = {row[0]: row[1:] for row in found(docs(texts))}
    for at in range(20):
        assert rows[at] == (2 + (at < 9) + (at < 14), int(at < 14), bodies[at])
    assert all(rows[at] == (4, 0, texts[at]) for at in (20, 21))


@pytest.mark.parametrize("copies", [2, 9, 10, 12, 1000])
def test_copies_keep_their_lines(docs, copies):
    """Exact copies, and near copies that differ in a word, beside lines that recur in unrelated documents."""
    rng = random.Random(copies)

    def words(size):
        return " ".join("".join(rng.choice("abcdefghijklm") for _ in range(7)) for _ in range(size))
    exact, body, short = (f"{words(12)}\n{words(24)}\n{words(8)}" for _ in range(3))
    common = words(25)
    texts = [exact] * copies + [f"{body} {words(1)}" for _ in range(copies)] + [f"{words(40)}\n{common}" for _ in range(12)]
    texts += [f"{common}\n{short}"] * copies
    rows = {row[0]: row[1:] for row in found(docs(texts))}
    assert all(rows[at] == (3, 0, texts[at]) for at in range(2 * copies))
    assert all(rows[at] == (2, 1, texts[at].split("\n")[0]) for at in range(2 * copies, 2 * copies + 12))
    assert all(rows[at] == (4, 1, short) for at in range(2 * copies + 12, len(texts)))


def test_brute_force_over_documents(documents):
    """Lines that at least ten documents share word for word (digits aside) go; the rest of each text stays in order."""
    import re
    from collections import Counter, defaultdict
    texts = {row["doc_id"]: row["text"] for row in documents.collect()}

    def masked(line):
        return re.sub(r"[^ \t\n\v\f\r]*[0-9][^ \t\n\v\f\r]*", "<*>", line).encode().split()
    lines = {key: {tuple(masked(line)) for line in text.split("\n")} - {()} for key, text in texts.items()}
    leaves, support = Counter(), Counter()
    for own in lines.values():
        leaves.update({(len(line), line[:2]) for line in own})
        support.update((len(line), line[:2], at, token) for line in own for at, token in enumerate(line))
    template = {}
    for line in set().union(*lines.values()):
        if leaves[(len(line), line[:2])] >= 10:
            parts = tuple(token if token != b"<*>" and support[(len(line), line[:2], at, token)] >= 10 else None for at, token in enumerate(line))
            if sum(part is not None for part in parts) >= 0.6 * len(parts):
                template[line] = (len(line), line[:2], parts)
    members = defaultdict(set)
    for key, own in lines.items():
        for line in own:
            if line in template:
                members[template[line]].add(key)
    gone = {line for line, name in template.items() if len(members[name]) >= 10}
    assert gone
    want = sorted((key, sum(bool(masked(line)) for line in text.split("\n")), sum(tuple(masked(line)) in gone for line in text.split("\n")),
                   "\n".join(line for line in text.split("\n") if tuple(masked(line)) not in gone)) for key, text in texts.items())
    assert sorted(found(documents)) == want


def test_signatures_agree_as_much_as_texts_share():
    rng = np.random.default_rng(3)
    for size in (1, 5, 40, 300, 20_000):
        agreeing, jaccard = [], []
        for share in (0.0, 0.5, 0.9, 1.0):
            for _ in range(40):
                common = rng.integers(0, 2**64, round(size * share), np.uint64)
                pair = [np.unique(np.concatenate([common, rng.integers(0, 2**64, size - len(common), np.uint64)])) for _ in range(2)]
                jaccard.append(len(common) / (2 * size - len(common)))
                agreeing.append(np.equal(*(np.frombuffer(signature(values), np.uint32) for values in pair)).mean())
        groups = np.array(agreeing).reshape(4, 40).mean(axis=1), np.array(jaccard).reshape(4, 40).mean(axis=1)
        assert np.abs(groups[0] - groups[1]).max() < 0.12 and groups[0][-1] == 1


def test_the_filter_holds_all_its_keys(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("key"))
    bits = key_filter(keys, "key")
    assert may_hold(bits, keys.toArrow()["key"].to_numpy()).all()
    others = np.random.default_rng(1).integers(-2**63, 2**63, 200_000)
    assert may_hold(bits, others).mean() < 1e-3 and len(may_hold(bits, others[:0])) == 0
    assert not may_hold(key_filter(keys.limit(0), "key"), others).any()


def test_documents_that_lose_nothing_keep_their_rows_beside_those_that_do(docs):
    texts = [f"head {at}\nthe footer line of every page here" for at in range(5)] + [f"{chr(97 + at % 26)}{chr(97 + at // 26)}word" for at in range(30)] + [None, ""]
    ids = [*range(35), 40, 40]
    rows = found(docs(texts + texts[5:8], ids + ids[5:8]), least=4)
    expected = [(at, 2, 1, f"head {at}") for at in range(5)] + [(at, 1, 0, texts[at]) for at in range(5, 35)] + [(40, 0, 0, None), (40, 0, 0, "")]
    assert rows == sorted(expected + expected[5:8], key=str)


def test_last_step_sends_each_text_to_python_once(docs):
    # the filter of documents that may lose a line reads the key alone; before, a third pass over all texts did
    texts = [f"{name} here\nPosted by user {name} at {at}:30 today in the forum" for at, name in enumerate("abcdefgh")]
    frame = without_recurring_lines(docs(texts), least=4)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan
    assert sorted(row[2] for row in frame.collect()) == [1] * 8
