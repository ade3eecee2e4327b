import random

from helpers import by, plan, rows
from ledgerloom.operators.dedup import first_by_key, latest_by_key

SCHEMA = "k string, t int, a string, b double"


def test_latest_wins_and_null_is_oldest(spark):
    df = spark.createDataFrame([("x", 1, "old", 1.0), ("x", 3, "new", 2.0), ("x", None, "none", 3.0),
                                ("y", None, "only", 4.0)], SCHEMA)
    kept = by(latest_by_key(df, ["k"], ["t"]), "k")
    assert kept["x"]["a"] == "new" and kept["y"]["a"] == "only"
    assert latest_by_key(df, ["k"], ["t"]).columns == ["k", "t", "a", "b"]


def test_ties_go_to_the_highest_remaining_columns_in_any_input_order(spark):
    data = [("x", 1, "a", 9.0), ("x", 1, "b", 1.0), ("x", 1, "b", 2.0), ("x", 1, None, 5.0)]
    for _ in range(4):
        random.shuffle(data)
        df = spark.createDataFrame(data, SCHEMA).repartition(3)
        assert rows(latest_by_key(df, ["k"], ["t"])) == [("x", 1, "b", 2.0)]
        assert rows(first_by_key(df.filter("a is not null"), ["k"], ["t"])) == [("x", 1, "a", 9.0)]


def test_identical_rows_leave_one(spark):
    df = spark.createDataFrame([("x", 1, "a", 1.0)] * 5, SCHEMA)
    assert rows(latest_by_key(df, ["k"], ["t"])) == [("x", 1, "a", 1.0)]


def test_null_key_is_a_key(spark):
    df = spark.createDataFrame([(None, 1, "a", 1.0), (None, 2, "b", 1.0)], SCHEMA)
    assert rows(latest_by_key(df, ["k"], ["t"])) == [(None, 2, "b", 1.0)]


def test_rows_are_combined_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("cast(id % 3 as string) k", "cast(id as int) t", "'a' a", "1d b")
    text = plan(latest_by_key(df, ["k"], ["t"]))
    before = text[text.index("Exchange hashpartitioning"):]
    assert "partial_max" in before and "Window" not in text
