import os
import shutil
from datetime import datetime

from helpers import raw, rows
from ledgerloom.operators.clean import silver
from ledgerloom.sources.bronze import land_json
from ledgerloom.streaming import order_events as stream

CLOCK = datetime(2024, 12, 1)
DAY = "2024-12-01"


def run(spark, root):
    stream.stream_silver_orders(spark, f"{root}/events", f"{root}/target", f"{root}/checkpoint", DAY, CLOCK,
                                files_per_batch=1).awaitTermination()


def counts(spark, root):
    got = stream.read_batch_counts(spark, f"{root}/target").collect()
    return [sum(row[name] for row in got) for name in ("received", "sent", "failed")]


def test_stream_equals_batch_over_replays_restarts_and_broken_lines(spark, root):
    first = raw(spark, "orders", {"status": "pending"}, {"order_id": "o2", "total": "-1"}, {"order_id": "o3"})
    land_json(first, f"{root}/events")
    with open(f"{root}/events/broken.json", "w") as file:
        file.write('{"order_id": "half\n')
    run(spark, root)
    files = len([name for name in os.listdir(f"{root}/events") if name.endswith(".json")])
    assert counts(spark, root) == [4, 3, 1]
    assert stream.read_batch_counts(spark, f"{root}/target").count() == files
    kept = rows(stream.read_streamed_orders(spark, f"{root}/target"))
    assert kept == rows(silver("orders", first, DAY, CLOCK))

    # A newer version, a late older one, numbers instead of text, and a file delivered twice.
    later = raw(spark, "orders", {"status": "shipped", "updated_at": "2024-11-09"},
                {"order_id": "o3", "status": "older", "updated_at": "2020-01-01"})
    land_json(later, f"{root}/events")
    replay = next(name for name in sorted(os.listdir(f"{root}/events")) if name.startswith("part"))
    shutil.copy(f"{root}/events/{replay}", f"{root}/events/again.json")
    run(spark, root)
    kept = rows(stream.read_streamed_orders(spark, f"{root}/target"))
    assert kept == rows(silver("orders", first.unionByName(later), DAY, CLOCK))
    assert {row[0]: row[2] for row in kept} == {"o1": "shipped", "o3": "shipped"}
    rejected = spark.read.parquet(f"{root}/target/rejected")
    assert rows(rejected.filter("line is null"), "order_id", "reject_reason")[0] == ("o2", "negative total")

    lines = rows(spark.read.parquet(f"{root}/target/rejected").filter("line is not null"), "order_id", "reject_reason", "line")
    assert lines == [(None, "unreadable line", '{"order_id": "half')]

    # Merged batches read alike, also with newer ones beside them.
    stream.merge_batches(spark, f"{root}/target")
    assert rows(stream.read_streamed_orders(spark, f"{root}/target")) == kept
    newest = raw(spark, "orders", {"order_id": "o3", "status": "delivered", "updated_at": "2024-12-24"})
    land_json(newest, f"{root}/events")
    run(spark, root)
    stream.merge_batches(spark, f"{root}/target")
    assert {row[0]: row[2] for row in rows(stream.read_streamed_orders(spark, f"{root}/target"))} == {"o1": "shipped", "o3": "delivered"}

    # Nothing new: nothing changes.
    before = counts(spark, root)
    run(spark, root)
    assert counts(spark, root) == before


def test_a_repeated_batch_leaves_one_copy(spark, root):
    data = raw(spark, "orders", {}).selectExpr("*", "cast(null as string) _corrupt_record")
    write = stream.batch_writer(f"{root}/target", DAY, CLOCK)
    write(data, 7)
    write(data, 7)
    assert spark.read.parquet(f"{root}/target/versions").count() == 1


def test_only_broken_lines_give_an_empty_table(spark, root):
    os.makedirs(f"{root}/events")
    with open(f"{root}/events/a.json", "w") as file:
        file.write("no json\n")
    run(spark, root)
    assert rows(stream.read_streamed_orders(spark, f"{root}/target")) == []
    assert counts(spark, root) == [1, 0, 1]


def test_raw_copy_keeps_broken_lines(spark, root):
    os.makedirs(f"{root}/events")
    with open(f"{root}/events/a.json", "w") as file:
        file.write('{"order_id": "o1", "total": 12.5}\nno json\n')
    stream.stream_to_bronze(spark, f"{root}/events", f"{root}/bronze", f"{root}/checkpoint").awaitTermination()
    got = spark.read.parquet(f"{root}/bronze")
    assert rows(got, "order_id", "total", "_corrupt_record") == [(None, None, "no json"), ("o1", "12.5", None)]
    assert "ingest_date" in got.columns


def test_a_merge_survives_replays_and_crashes(spark, root, monkeypatch):
    def batch(*changes):
        return raw(spark, "orders", *changes).selectExpr("*", "cast(null as string) _corrupt_record")
    target = f"{root}/target"
    write = stream.batch_writer(target, DAY, CLOCK)
    first = batch({"status": "pending"}, {"order_id": "o2"})
    write(first, 0)
    write(batch({"status": "shipped", "updated_at": "2024-11-09"}), 1)
    want = rows(stream.read_streamed_orders(spark, target))
    assert {row[0]: row[2] for row in want} == {"o1": "shipped", "o2": "shipped"}

    # Broken off before the commit: nothing is lost, and the next merge is complete.
    def crash(*_):
        raise OSError("lost")
    with monkeypatch.context() as patch:
        patch.setattr(stream, "commit_merge", crash)
        try:
            stream.merge_batches(spark, target)
        except OSError:
            pass
    assert rows(stream.read_streamed_orders(spark, target)) == want
    # Broken off between the commit and the removal of batches.
    with monkeypatch.context() as patch:
        patch.setattr(stream, "remove_folder", crash)
        try:
            stream.merge_batches(spark, target)
        except OSError:
            pass
    assert rows(stream.read_streamed_orders(spark, target)) == want
    stream.merge_batches(spark, target)
    assert rows(stream.read_streamed_orders(spark, target)) == want
    assert [name for name in os.listdir(f"{target}/versions") if name.startswith("batch_id")] == []

    # A merged batch is replayed: alike, it changes nothing; with a newer version, that counts.
    write(first, 0)
    assert rows(stream.read_streamed_orders(spark, target)) == want
    write(batch({"status": "delivered", "updated_at": "2024-12-24"}), 0)
    for _ in range(4):
        stream.merge_batches(spark, target)
        assert {row[0]: row[2] for row in rows(stream.read_streamed_orders(spark, target))} == {"o1": "delivered", "o2": "shipped"}
    assert len(os.listdir(f"{target}/current")) <= 3


def test_json_sink_counts_failed_lines_over_restarts(spark, root):
    os.makedirs(f"{root}/events")

    def sink():
        return {row["batch_id"]: tuple(row)[1:] for row in stream.stream_to_json(
            spark, f"{root}/events", f"{root}/json", f"{root}/checkpoint", rows_per_file=2, files_per_batch=1).collect()}
    for at in range(2):
        with open(f"{root}/events/{at}.json", "w") as file:
            file.write("".join(f'{{"order_id": "o{at}{line}", "total": 12.5}}\n' for line in range(5)) + "no json\n" * at)
    first = sink()
    assert sorted(first) == [0, 1] and sorted(first.values()) == [(5, 0, 5), (6, 1, 5)]
    with open(f"{root}/events/2.json", "w") as file:
        file.write('{"order_id"\n{"order_id": "o20"}\n')
    assert sink() == {2: (2, 1, 1)} and sink() == {}
    sent = stream.read_json_events(spark, f"{root}/json")
    assert rows(sent, "order_id") == [(f"o{at}{line}",) for at in range(2) for line in range(5)] + [("o20",)]
    assert rows(stream.read_json_events(spark, f"{root}/json", stream.FAILED)) == [("no json",), ('{"order_id"',)]
    sizes = [row["count"] for row in sent.groupBy("_metadata.file_path").count().collect()]
    assert max(sizes) <= 2 and len(sizes) == 7
