from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import mixing as module
from ledgerloom.llm._frames import Workspace
from ledgerloom.llm.mixing import mix_report, mixed, permuted, planned_mix, shard_quotas
from llm.texts import goals, long_text


def targets(spark, sizes):
    rows = spark.createDataFrame([(at, size, module.WEIGHTS[at % 3]) for at, size in enumerate(sizes)], "number int, size bigint, weight double")
    return [row["target"] for row in module.targets(Workspace(spark, "targets"), rows).orderBy("number").collect()]


def test_targets_share_by_weight_below_the_bound(spark):
    sizes = [100, 1000, 10, 0, 500]
    got = targets(spark, sizes)
    assert sum(got) == pytest.approx(1.5 * sum(sizes)) and all(a <= 2 * b + 1e-9 for a, b in zip(got, sizes, strict=True))
    assert got[0] == 200 and got[2] == 20 and got[3] == 0
    # the open ones keep the ratio of their weights: 1 and 1
    assert got[4] == 1000 and got[1] == pytest.approx(1.5 * 1610 - 1220)
    assert targets(spark, []) == [] and targets(spark, [0, 0]) == [0, 0] and targets(spark, [10]) == [15]
    assert targets(spark, [100, 100, 100]) == pytest.approx([200, 83.3333333, 166.6666667])
    sizes = [3 ** (at % 9) * (at + 1) for at in range(200)]
    assert targets(spark, sizes) == pytest.approx(goals(sizes))


def test_shards_of_many_blocks_are_alike():
    """A million blocks, a third of them of one source: every shard has its number, give or take one per level of the tree."""
    blocks = [333_334, *[166] * 4000, 2666]
    sizes = [int(shard_quotas(blocks, 15_625, shard)[1].sum()) for shard in (0, 1, 2, 777, 8000, 15_623, 15_624)]
    assert all(abs(size - 64) <= 1 for size in sizes)


def test_a_tree_deals_every_block_once():
    blocks, shards = [7, 0, 100, 33], 9
    dealt = [set() for _ in blocks]
    totals = []
    for shard in range(shards):
        first, count = shard_quotas(blocks, shards, shard)
        totals.append(int(count.sum()))
        for source in range(len(blocks)):
            part = {permuted(int(i), blocks[source], 3) for i in range(first[source], first[source] + count[source])}
            assert not part & dealt[source]
            dealt[source] |= part
    assert [len(x) for x in dealt] == blocks and all(x == set(range(n)) for x, n in zip(dealt, blocks, strict=True))
    assert max(totals) - min(totals) <= 2


def test_splits_are_hypergeometric():
    counts = np.array([shard_quotas([30, 70], 2, 0, seed)[1] for seed in range(2000)])
    assert set(counts.sum(axis=1)) == {50} and abs(counts[:, 0].mean() - 15) < 0.3
    assert abs(counts[:, 0].var() - 50 * 0.3 * 0.7 * 50 / 99) < 0.6


def check_mix(rows, texts):
    """What holds for any mix: sizes, bounds, targets, nearness."""
    totals, taken, largest = Counter(), Counter(), Counter()
    for row in rows:
        assert row["size"] == len((texts[row["doc_id"]][0] or "").encode().split()) and row["taken"] <= 2 * row["size"]
        source = texts[row["doc_id"]][1]
        totals[source] += row["size"]
        taken[source] += row["taken"]
        largest[source] = max(largest[source], row["size"])
    names = sorted(totals, key=lambda name: (name is None, name or ""))
    goal = dict(zip(names, goals([totals[name] for name in names]), strict=True))
    for row in rows:
        source = texts[row["doc_id"]][1]
        assert row["source_size"] == totals[source] and row["target"] == pytest.approx(goal[source])
    for name in names:
        assert abs(taken[name] - goal[name]) <= largest[name] / 2 + 1


def test_mix_of_documents(documents):
    texts = {row["doc_id"]: (row["text"], row["source"]) for row in documents.collect()}
    rows = mix_report(documents).collect()
    assert len(rows) == len(texts)
    check_mix(rows, texts)
    again = mix_report(documents.repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_of_edge_rows(docs):
    texts = ["a b c", None, "", "x " * 500, "y", "z z", long_text(2000), *(f"t{i} " * (i % 9 + 1) for i in range(300))]
    sources = {0: None, 1: None, 2: "empty", 3: "b", 4: "é", 5: ""} | {at: "hot" for at in range(6, len(texts))}
    frame = docs(texts, sources=sources)
    check_mix(mix_report(frame).collect(), {at: (text, sources[at]) for at, text in enumerate(texts)})


def test_rows_of_the_mix(docs, monkeypatch):
    monkeypatch.setattr(module, "SHARD_WORDS", 100)
    monkeypatch.setattr(module, "BLOCK_WORDS", 16)
    frame = docs([f"word{i} " * (i % 7 + 1) for i in range(200)], sources={at: f"s{at % 3}" for at in range(200)})
    inside = frame.select("doc_id", "text", "source", "lang")
    want = {row["doc_id"]: row["taken"] // row["size"] for row in mix_report(inside).collect()}
    rows = mixed(inside, "shard")
    assert rows.columns == [*inside.columns, "shard"]
    got = rows.collect()
    assert Counter(row["doc_id"] for row in got) == Counter({key: n for key, n in want.items() if n})
    assert len({row["shard"] for row in got}) > 5
    shards = {row["doc_id"]: row["shards"] for row in planned_mix(inside).collect()}
    assert Counter((row["doc_id"], row["shard"]) for row in got) == Counter((key, s) for key, x in shards.items() for s in x)


def test_more_sources_than_urns(docs, monkeypatch):
    """Sources share urns by number; every block goes to one shard, also where a source has many blocks."""
    monkeypatch.setattr(module, "SHARD_WORDS", 500)
    monkeypatch.setattr(module, "BLOCK_WORDS", 8)
    monkeypatch.setattr(module, "URNS", 16)
    texts = [f"w{at} " * (at % 11 + 1) for at in range(3000)]
    sources = {at: "hot" if at % 3 == 0 else f"s{at % 700}" for at in range(3000)}
    frame = docs(texts, sources=sources).select("doc_id", "text", "source")
    rows = planned_mix(frame).collect()
    check_mix([{**row.asDict(), "taken": row["size"] * len(row["shards"])} for row in rows], {at: (text, sources[at]) for at, text in enumerate(texts)})
    shards = Counter()
    for row in rows:
        for shard in row["shards"]:
            shards[shard] += row["size"]
    assert len(shards) == -(-sum(goals_of(rows)) // 500) and max(shards.values()) < 2 * min(shards.values())


def goals_of(rows):
    return {row["source"]: row["target"] for row in rows}.values()


def test_many_sources(docs):
    """Each document a source of its own."""
    texts = [f"w{at} " * (at % 5) for at in range(20_000)]
    sources = {at: f"s{at}" for at in range(len(texts))}
    check_mix(mix_report(docs(texts, sources=sources)).collect(), {at: (text, sources[at]) for at, text in enumerate(texts)})


def test_null_and_repeated_ids_and_empty_table(docs):
    rows = mix_report(docs(["a b", "a b", "c", "d"], [None, None, 1, 1])).collect()
    assert len(rows) == 4 and all(row["target"] == 9 for row in rows)
    assert mix_report(docs([])).count() == 0 and mixed(docs([]).select("doc_id", "text", "source")).count() == 0


def test_sizes_count_words_as_bytes_split(spark):
    texts = ["a\x0bb\x0cc\rd", "a\x1cb", " a b ", " ", "\n", "ä ö"]
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    assert [row[0] for row in frame.select(module.words(F.col("text"))).collect()] == [len(text.encode().split()) for text in texts]
