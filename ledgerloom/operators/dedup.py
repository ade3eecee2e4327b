"""One row per key, by a total order over all columns, so reruns keep the same row.

Both operators are one aggregate over the whole row as a struct. Each map task combines the rows
of a key before the shuffle, so a key holding a third of all rows sends one row per task, and no
task ever holds the rows of a key together. Structs compare field by field, nulls lowest.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _one_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                pick: Callable[[Column], Column], counts: Column | None = None) -> DataFrame:
    names = df.columns
    ranked = F.struct(*order, *[name for name in names if name not in keys and name not in order])
    row = ranked if counts is None else F.when(counts, ranked)
    rows = df.groupBy(*keys).agg(pick(row).alias("_row"))
    if counts is not None:
        rows = rows.filter(F.col("_row").isNotNull())
    return rows.select(*keys, "_row.*").select(*names)


def latest_by_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str] = (), counts: Column | None = None) -> DataFrame:
    """Keep the row with the highest ``newest`` columns of each key; null counts as oldest.

    Ties fall to the highest remaining columns in column order. Only rows for which ``counts`` is true take part; it is
    tested within the aggregate, as a filter before it would work out the columns it reads a second time.
    """
    return _one_by_key(df, keys, newest, F.max, counts)


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keep the row with the lowest ``order`` columns of each key; null counts as lowest.

    Ties fall to the lowest remaining columns in column order.
    """
    return _one_by_key(df, keys, order, F.min)
