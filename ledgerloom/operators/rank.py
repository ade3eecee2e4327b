"""Ranks and quantiles over a whole table without sorting it in one task.

Rows are range partitioned by value into slices. What a slice needs to know of the others is how
many rows lie before it, which is one row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.staging import stage

SKETCH_SIZE = 200


def _before(slices: DataFrame, rows: str) -> DataFrame:
    """Add ``_before``, the rows of all earlier slices, to one row per slice."""
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return slices.withColumn("_before", F.coalesce(F.sum(rows).over(earlier), F.lit(0)))


def _value_ranks(df: DataFrame, by: str, out: str, folder: str | None) -> DataFrame:
    """``_row`` and the ``rank()`` of each row by ``by`` descending, nulls last, as bigint.

    Slices are cut by value and then by a hash of the row, so a value shared by a third of the rows goes
    to many slices. Within a slice a rank is the slice's offset plus the rank there. A value that spans slices has its rank
    in the first of them: the smallest of the ranks that the slices it begins or ends would give it.
    """
    place = F.col("_value").desc_nulls_last()
    rows = (df.select("_row", F.col(by).alias("_value")).repartitionByRange(place, F.xxhash64("_row"))
            .withColumn("_slice", F.spark_partition_id()))
    inside = F.rank().over(Window.partitionBy("_slice").orderBy(place)).cast("bigint")
    rows = stage(rows.withColumn("_inside", inside), f"slices-{out}", folder)
    slices = _before(rows.groupBy("_slice").agg(
        F.count(F.lit(1)).alias("_rows"), F.max("_inside").alias("_last"), F.max("_value").alias("_first_value"),
        F.when(F.count(F.lit(1)) == F.count("_value"), F.min("_value")).alias("_last_value")), "_rows")
    ends = (slices.select(F.col("_first_value").alias("_end"), (F.col("_before") + 1).alias("_rank"))
            .unionByName(slices.select(F.col("_last_value").alias("_end"), (F.col("_before") + F.col("_last")).alias("_rank")))
            .groupBy("_end").agg(F.min("_rank").alias("_rank")))
    offsets = slices.join(ends, F.col("_first_value").eqNullSafe(F.col("_end"))).select(
        "_slice", "_before", "_first_value", "_rank")
    rank = F.when(F.col("_value").eqNullSafe(F.col("_first_value")), F.col("_rank")).otherwise(F.col("_before") + F.col("_inside"))
    return rows.join(offsets, "_slice").select("_row", rank.alias(out))


def global_rank(df: DataFrame, ranks: dict[str, str], folder: str | None = None) -> DataFrame:
    """Add one bigint rank column per ``{output column: value column}``, highest value first.

    ``df`` is staged with a number per row. Only that and the value are sorted; ranks come back by the
    number, for which the whole rows are shuffled once. ``folder`` is where tables are staged.
    """
    result = rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "rank-input", folder)
    for out, by in ranks.items():
        result = result.join(_value_ranks(rows, by, out, folder), "_row")
    return result.drop("_row")


def quantiles(df: DataFrame, columns: Sequence[str], points: Sequence[float], folder: str | None = None) -> DataFrame:
    """One row with an array per column: the smallest values that at least each part of the rows does not exceed.

    Nulls are left out; a column without values gives nulls. Exact, so the same on any cluster. Rows are counted per value,
    and only the values are sorted, in slices.
    """
    result = None
    for name in columns:
        counts = (df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
                  .repartitionByRange("_value").withColumn("_slice", F.spark_partition_id()))
        counts = stage(counts, f"quantiles-{name}", folder)
        before = _before(counts.groupBy("_slice").agg(F.sum("_rows").alias("_total")), "_total").select("_slice", "_before")
        upto = F.sum("_rows").over(Window.partitionBy("_slice").orderBy("_value")) + F.col("_before")
        total = counts.agg(F.sum("_rows")).scalar()
        found = counts.join(before, "_slice").withColumn("_upto", upto).agg(F.array(*(
            F.min(F.when(F.col("_upto") >= F.ceil(total * F.lit(point)), F.col("_value"))) for point in points)).alias(name))
        result = found if result is None else result.select("*", found.select(name).scalar().alias(name))
    return result


def sketched_quantiles(df: DataFrame, columns: Sequence[str], points: Sequence[float], size: int = SKETCH_SIZE) -> DataFrame:
    """Like ``quantiles``, of doubles and within a rank error, from one sketch per column in one aggregate.

    Sketches of a fixed size are combined before the shuffle, so values are neither shuffled nor sorted. With the given size ranks
    are mostly off by less than 0.02, whatever the number of rows; which value is taken may change from run to run.
    """
    wanted = F.array(*map(F.lit, points))
    sketches = df.agg(*(F.kll_sketch_agg_double(F.col(name).cast("double"), size).alias(name) for name in columns),
                      *(F.count(name).alias(f"_n_{at}") for at, name in enumerate(columns)))
    none = F.array_repeat(F.lit(None).cast("double"), len(points))
    return sketches.select(*(F.when(F.col(f"_n_{at}") > 0, F.kll_sketch_get_quantile_double(name, wanted)).otherwise(none).alias(name)
                             for at, name in enumerate(columns)))
