"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance is never formed. Every pass over the vectors multiplies it with a block of columns: tasks centre
their vectors, multiply them with the block and the products with the vectors again, and Spark adds up the
results per dimension. A polynomial recurrence of such passes damps the part of the spectrum below the block's smallest Ritz value
and lets the rest grow; QR and Rayleigh-Ritz then give the next block. It ends when the residuals of all
wanted components certify them to rounding.

Entries ``c`` count as whole numbers ``floor(1024 * c) + 100000``, so sums and deviations are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm._frames import Workspace, map_arrow

COMPONENTS = 8
BLOCK = 32  # columns of the block; those beyond the components speed up convergence
DEGREE = 8  # multiplications per filter
CERTIFIED = 1e-13  # largest residual of a component, as part of the largest eigenvalue
MAX_ROUNDS = 60
_EDGE = float(1 << 62)  # entries beyond count as the longs at the edge
_LOW = (1 << 32) - 1


def _numbers(lists: pa.Array, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are whole (not null, of the size, all entries finite), and their numbers as a matrix of longs."""
    sizes = np.diff(lists.offsets.to_numpy())
    valid = lists.is_valid().to_numpy(zero_copy_only=False)
    whole = valid & (sizes == size)
    entries = lists.filter(pa.array(whole)).flatten().cast(pa.float64())
    matrix = entries.to_numpy(zero_copy_only=False).reshape(-1, size)  # null as not a number
    finite = np.isfinite(matrix).all(axis=1)
    whole[np.flatnonzero(whole)[~finite]] = False
    return whole, np.clip(np.floor(1024.0 * matrix[finite]), -_EDGE, _EDGE).astype(np.int64) + 100_000


def _prepared(vectors: DataFrame, key: str, size: int) -> DataFrame:
    """``<key>, x``: the numbers of the whole vectors, as bytes of 4 or 8 per entry."""
    def over(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        whole, numbers = _numbers(batch.column("vector"), size)
        if len(numbers):
            small = np.abs(numbers).max() < 1 << 31
            rows = [row.tobytes() for row in numbers.astype("<i4" if small else "<i8")]
            yield pa.RecordBatch.from_arrays([batch.column(key).filter(pa.array(whole)), pa.array(rows, pa.binary())], [key, "x"])
    return map_arrow(vectors, over, f"{key} {vectors.schema[key].dataType.simpleString()}, x binary")


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """The rows of a batch as longs."""
    parts = [np.frombuffer(row, "<i4" if len(row) == 4 * size else "<i8") for row in column.to_pylist()]
    return np.array(parts, np.int64).reshape(-1, size)


class _Fit:
    """Count, sums and covariance products of the prepared vectors."""

    def __init__(self, rows: DataFrame, size: int):
        self.rows, self.size = rows.select("x"), size

        def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, high, low = 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
            for batch in batches:
                numbers = _matrix(batch.column("x"), size)
                total += len(numbers)
                high += (numbers >> 32).sum(axis=0)
                low += (numbers & _LOW).sum(axis=0)
            yield pa.RecordBatch.from_pydict({"at": np.arange(size), "n": np.full(size, total), "high": high, "low": low})

        sums = self.rows.mapInArrow(over, "at long, n long, high long, low long").groupBy("at").agg(
            F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
        sums = sorted(sums)
        self.count = sums[0]["n"] if sums else 0
        self.sums = [(row["high"] << 32) + row["low"] for row in sums]  # whole numbers of any size
        count = max(self.count, 1)
        self.base = np.array([total // count for total in self.sums], np.int64)  # the mean, rounded down
        self.rest = [total % count for total in self.sums]
        self.mean = np.array([rest / count for rest in self.rest])  # of numbers minus base

    def times(self, block: np.ndarray) -> np.ndarray:
        """The covariance times a block, by one pass over the vectors."""
        size, base, mean, count = self.size, self.base, self.mean, self.count
        width = block.shape[1]

        def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            product = np.zeros((size, width))
            for batch in batches:
                centred = (_matrix(batch.column("x"), size) - base) - mean
                product += centred.T @ (centred @ block)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), *(pa.array(column) for column in product.T.copy())],
                                             ["at", *names])

        names = [f"c{at}" for at in range(width)]
        schema = "at long, " + ", ".join(f"{name} double" for name in names)
        rows = self.rows.mapInArrow(over, schema).groupBy("at").agg(*(F.sum(name).alias(name) for name in names)).toArrow()
        found = np.zeros((size, width))
        found[rows["at"].to_numpy()] = np.column_stack([rows[name].to_numpy() for name in names])
        return found / count

    def variances(self) -> np.ndarray:
        """The diagonal of the covariance."""
        size, base, mean = self.size, self.base, self.mean

        def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                total += np.square((_matrix(batch.column("x"), size) - base) - mean).sum(axis=0)
            yield pa.RecordBatch.from_pydict({"at": np.arange(size), "v": total})

        rows = self.rows.mapInArrow(over, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
        found = np.zeros(size)
        found[rows["at"].to_numpy()] = rows["v"].to_numpy()
        return found / self.count


def _ritz(block: np.ndarray, product: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values in falling order, vectors, and the covariance times the vectors."""
    small = block.T @ product
    values, turns = np.linalg.eigh((small + small.T) / 2)
    turns = turns[:, ::-1]
    return values[::-1], block @ turns, product @ turns


def _filtered(fit: _Fit, vectors: np.ndarray, product: np.ndarray, edge: float, top: float) -> np.ndarray:
    """The Chebyshev polynomial of the covariance that stays small on [0, edge], times the vectors, scaled at ``top``.

    ``product`` is the covariance times the vectors, so the first multiplication is there already.
    """
    middle = half = edge / 2
    scale = first = half / (top - middle)
    before, now = vectors, (product - middle * vectors) * (first / half)
    for _ in range(DEGREE - 1):
        following = 1 / (2 / first - scale)
        before, now = now, (2 * following / half) * (fit.times(now) - middle * now) - (scale * following) * before
        scale = following
    return now


def principal_axes(fit: _Fit, wanted: int, block: int = BLOCK, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of the covariance, falling, and their unit vectors as columns."""
    width = min(fit.size, max(block, wanted))
    vectors = np.linalg.qr(np.random.default_rng(seed).standard_normal((fit.size, width)))[0]
    best = None
    for _ in range(MAX_ROUNDS):
        product = fit.times(vectors)
        values, vectors, product = _ritz(vectors, product)
        if values[0] <= 0:
            return np.maximum(values[:wanted], 0), vectors[:, :wanted]
        residual = np.linalg.norm(product - vectors * values, axis=0)[:wanted].max() / values[0]
        if residual <= CERTIFIED or width == fit.size:
            return np.maximum(values[:wanted], 0), vectors[:, :wanted]
        if best is not None and residual > best / 2 and residual <= 100 * CERTIFIED:
            return np.maximum(values[:wanted], 0), vectors[:, :wanted]  # as far as rounding lets it go
        best = residual if best is None else min(best, residual)
        edge = min(max(values[-1], values[0] * 1e-12), values[0] * 0.999)
        vectors = np.linalg.qr(_filtered(fit, vectors, product, edge, values[0]))[0]
    raise ArithmeticError(f"components not certified after {MAX_ROUNDS} rounds: residual {residual:.1e}")


def _deviations(numbers: np.ndarray, fit_count: int, base: np.ndarray, rest: list[int]) -> list[int]:
    """Per row the sum over dimensions of ``(n * x - S) ** 2``, exact."""
    centred = numbers - base  # n * x - S = n * centred - rest
    far = int(np.abs(centred).max(initial=0))
    if far * max(far, fit_count) * centred.shape[1] >= 1 << 62:
        centred, rest_row = centred.astype(object), np.array(rest, object)
    else:
        rest_row = np.array(rest, np.int64)
    squares, across = (centred * centred).sum(axis=1), (centred * rest_row).sum(axis=1)
    constant = sum(one * one for one in rest)
    return [fit_count * fit_count * int(a) - 2 * fit_count * int(b) + constant for a, b in zip(squares, across, strict=True)]


def whitened(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """``<key>, component, n, deviation, whitened, explained, identity_error`` of every whole vector and component.

    Vectors that are null or hold null or non-finite entries are dropped; so are those whose length is not the most
    frequent one (of equal counts the greatest), as they lack entries or have some of no dimension. Ids may be null, and repeated
    rows count as often as they stand there. There are as many components as dimensions at most. A component without variance
    (all vectors alike, fewer vectors than components) has a null ``whitened`` and counts nowhere in ``identity_error``;
    ``explained`` is null where no dimension varies. A ``deviation`` beyond a long is null.
    Components with equal eigenvalues are any basis of their space. An empty table gives no rows; other columns are
    ignored, whatever their names; texts play no part.
    """
    spark, kind = vectors.sparkSession, vectors.schema[key].dataType.simpleString()
    work = Workspace(spark, "whitening")
    rows = vectors.select(F.col(key), F.col(vector).alias("vector"))
    schema = f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    sizes = (rows.where("vector IS NOT NULL AND size(vector) > 0").groupBy(F.size("vector").alias("size")).count()
             .orderBy(F.desc("count"), F.desc("size")).first())
    if sizes is None:
        return spark.createDataFrame([], schema)
    size = sizes["size"]
    prepared = work.stage(_prepared(rows, key, size), "numbers")
    fit = _Fit(prepared, size)
    if not fit.count:
        return spark.createDataFrame([], schema)
    trace = float(fit.variances().sum())
    values, axes = principal_axes(fit, min(components, size))
    varied = values > max(trace, 0) * size * np.finfo(float).eps
    scaled = np.divide(axes, np.sqrt(values), out=np.zeros_like(axes), where=varied)
    # the whitened covariance, over the whitened vectors themselves
    count, base, mean, rest = fit.count, fit.base, fit.mean, fit.rest

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((scaled.shape[1], scaled.shape[1]))
        for batch in batches:
            white = ((_matrix(batch.column("x"), size) - base) - mean) @ scaled
            total += white.T @ white
        yield pa.RecordBatch.from_pydict({"at": np.arange(total.size), "v": total.ravel()})

    found = prepared.select("x").mapInArrow(products, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    identity = np.zeros(scaled.shape[1] ** 2)
    for at, value in found:
        identity[at] = value / count
    off = np.abs(identity.reshape(scaled.shape[1], -1) - np.eye(scaled.shape[1]))[np.ix_(varied, varied)]
    error = float(off.max()) if off.size else None

    def over(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        numbers = _matrix(batch.column("x"), size)
        white = ((numbers - base) - mean) @ scaled
        wide, many = white.shape[1], len(numbers)
        deviations = [one if one < 1 << 63 else None for one in _deviations(numbers, count, base, rest)]
        at = pa.array(np.repeat(np.arange(many), wide))
        yield pa.RecordBatch.from_arrays([
            batch.column(key).take(at), pa.array(np.tile(np.arange(1, wide + 1, dtype=np.int32), many)),
            pa.array(np.full(many * wide, count)), pa.array(deviations, pa.int64()).take(at),
            pa.array(white.ravel(), mask=~np.tile(varied, many)),
            pa.array(np.tile(values / trace if trace > 0 else np.zeros(wide), many), mask=np.full(many * wide, trace <= 0)),
            pa.array([error] * (many * wide), pa.float64())], names)

    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return map_arrow(prepared, over, schema)
