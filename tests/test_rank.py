import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import rows
from ledgerloom.operators.rank import global_rank, quantiles, sketched_quantiles

RANKS = {"by_v": "v", "by_u": "u"}


def frame(spark, n):
    """A third of all rows share one value; others repeat a little; some are null."""
    return spark.range(n).selectExpr(
        "id", "case when id % 3 = 0 then 50.5d when id % 41 = 1 then null else cast(id * 37 % 900 as double) end v",
        "id * 7 % 13 u")


def plain(df):
    return df.withColumns({out: F.rank().over(Window.orderBy(F.col(by).desc_nulls_last())).cast("bigint") for out, by in RANKS.items()})


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_slices_equal_a_plain_window(spark, n):
    found = global_rank(frame(spark, n), RANKS)
    assert found.columns == ["id", "v", "u", "by_v", "by_u"] and dict(found.dtypes)["by_v"] == "bigint"
    assert rows(found) == rows(plain(frame(spark, n)))


def test_one_value_over_all_slices_and_rows_alike(spark):
    df = spark.range(900).selectExpr("nullif(id % 5, 2) id", "case when id = 7 then 2d else 1d end v", "cast(null as int) u")
    assert rows(global_rank(df, RANKS)) == rows(plain(df))


def test_no_window_over_rows_without_partition(spark):
    text = global_rank(frame(spark, 3000), RANKS)._jdf.queryExecution().executedPlan().toString()
    # one row per slice is the only thing brought together
    for line in text.splitlines():
        assert "SinglePartition" not in line or "ENSURE_REQUIREMENTS" in line
    single = [line for line in text.splitlines() if "Window [sum(_rows" in line.replace("#", " ")]
    assert all("_slice" in line for line in single)


@pytest.mark.parametrize("parts", [8, 64])
def test_quantiles_are_exact_on_any_cluster(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = quantiles(frame(spark, 5003), ["v", "u"], [0.25, 0.5, 0.75]).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for name in ("v", "u"):
        values = sorted(row[0] for row in frame(spark, 5003).where(f"{name} is not null").select(name).collect())
        assert found[name] == [values[-(-len(values) * quarter // 4) - 1] for quarter in (1, 2, 3)]


def test_quantiles_of_nothing(spark):
    assert quantiles(frame(spark, 0), ["v"], [0.5]).first()["v"] == [None]


@pytest.mark.parametrize("parts", [8, 64])
def test_sketched_quantiles_keep_their_rank_error(spark, parts):
    values = spark.range(100_003).selectExpr("cast(pmod(xxhash64(id), 9000) as double) v", "if(id % 3 = 0, 7, id) w", "cast(null as int) u")
    found = sketched_quantiles(values.repartition(parts), ["v", "w", "u"], [0.25, 0.5, 0.75]).first()
    for name in ("v", "w"):
        rows_of = sorted(row[0] for row in values.select(name).collect())
        for part, value in zip((0.25, 0.5, 0.75), found[name], strict=True):
            assert sum(x < value for x in rows_of) / len(rows_of) <= part + 0.05
            assert sum(x <= value for x in rows_of) / len(rows_of) >= part - 0.05
    assert found["u"] == [None] * 3
    plan = sketched_quantiles(values, ["v", "w"], [0.5])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Sort" not in plan
