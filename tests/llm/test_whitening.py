import math

import numpy as np
import pytest

from ledgerloom.llm import whitening
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.whitening import _deviations, _Fit, _prepared, principal_axes, whitened

SCHEMA = "vec_id long, embedding array<float>, component string, n string, x string, vector int"


def frame(spark, vectors, ids=None):
    return spark.createDataFrame([(i, v, "c", "n", "x", 1) for i, v in zip(ids or range(len(vectors)), vectors, strict=True)], SCHEMA)


def numbers(vectors):
    return [[math.floor(1024 * float(np.float32(c))) + 100000 for c in vector] for vector in vectors]


def check(rows, vectors, ids=None, components=8):
    """Against the covariance's eigenvectors, and whole numbers for sums and deviations."""
    ids = list(ids if ids is not None else range(len(vectors)))
    x = numbers(vectors)
    n, size = len(x), len(x[0])
    sums = [sum(row[d] for row in x) for d in range(size)]
    centred = np.array([[value - total / n for value, total in zip(row, sums, strict=True)] for row in x])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    wide = min(components, size)
    assert len(rows) == n * wide
    deviations = [sum((n * value - total) ** 2 for value, total in zip(row, sums, strict=True)) for row in x]
    assert sorted((row["vec_id"] if row["vec_id"] is not None else -1, row["deviation"]) for row in rows if row["component"] == 1) == sorted(
        (i if i is not None else -1, d) for i, d in zip(ids, deviations, strict=True))
    assert {row["n"] for row in rows} == {n}
    white = centred @ axes[:, :wide] / np.sqrt(values[:wide])
    for component in range(1, wide + 1):
        mine = [row for row in rows if row["component"] == component]
        assert math.isclose(mine[0]["explained"], values[component - 1] / np.trace(covariance), rel_tol=1e-10)
        assert mine[0]["identity_error"] < 1e-9
        if len(set(ids)) == len(ids):
            by_id = {row["vec_id"]: row["whitened"] for row in mine}
            got, expected = np.array([by_id[i] for i in ids]), white[:, component - 1]
            sign = np.sign(got @ expected)
            assert np.allclose(sign * got, expected, rtol=0, atol=1e-7)


def test_query_equals_the_covariance(spark):
    rows = QUERIES["op11_whitening"](spark, "/root/testdata/sf0.01").collect()
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()
    whole = [row for row in table if row["embedding"] is not None and all(c is not None and math.isfinite(c) for c in row["embedding"])]
    check(rows, [row["embedding"] for row in whole], [row["vec_id"] for row in whole])


def test_broken_vectors_repeats_and_null_ids(spark):
    spread = np.random.default_rng(5)
    good = spread.normal(size=(40, 12)).astype(np.float32).tolist()
    broken = [None, [], [None] * 12, [*good[0][:-1], None], [*good[0][:-1], math.inf], [*good[0][:-1], math.nan], good[0][:5], [*good[0], 1.0]]
    rows = whitened(frame(spark, [*broken, *good, good[3]], [*range(-8, 0), None, *range(1, 40), None])).collect()
    check(rows, [*good, good[3]], [None, *range(1, 40), None])
    check(whitened(frame(spark, [row[:3] for row in good])).collect(), [row[:3] for row in good])


def test_no_variance_and_no_rows(spark):
    for vectors, count in (([], 0), ([None, []], 0), ([[math.nan, 1.0]], 0), ([[1.0, 2.0]], 2), ([[1.0, 2.0, 3.0]] * 5, 15)):
        rows = whitened(frame(spark, vectors)).collect()
        assert len(rows) == count
        assert all(row["whitened"] is None and row["explained"] is None and row["deviation"] == 0 for row in rows)
    rows = whitened(frame(spark, [[0.0, 0.0, 5.0], [4.0, 0.0, 5.0]])).collect()
    assert sorted((row["vec_id"], row["component"], row["whitened"] and round(abs(row["whitened"]), 9)) for row in rows) == [
        (0, 1, 1.0), (0, 2, None), (0, 3, None), (1, 1, 1.0), (1, 2, None), (1, 3, None)]
    assert {round(row["explained"], 12) for row in rows} == {1.0, 0.0}


@pytest.mark.parametrize("spectrum", [np.linspace(1, 30, 120), 0.8 ** np.arange(120), np.r_[np.ones(9) * 5, np.ones(111)],
                                      np.full(120, 2.0)])
def test_filter_finds_components_of_many_dimensions(spark, monkeypatch, spectrum):
    spread = np.random.default_rng(7)
    data = (spread.normal(size=(400, 120)) * np.sqrt(spectrum)) @ np.linalg.qr(spread.normal(size=(120, 120)))[0]
    data = data.astype(np.float32).tolist()
    prepared = _prepared(frame(spark, data).selectExpr("vec_id", "embedding AS vector"), "vec_id", 120).cache()
    values, axes = principal_axes(_Fit(prepared, 120), 8, block=16)
    x = np.array(numbers(data), float)
    centred = x - x.mean(axis=0)
    covariance = centred.T @ centred / len(x)
    assert np.allclose(values, np.linalg.eigvalsh(covariance)[::-1][:8], rtol=1e-11)
    assert np.linalg.norm(covariance @ axes - axes * values, axis=0).max() < 1e-11 * values[0]


def test_deviations_are_whole_numbers_of_any_size():
    spread = np.random.default_rng(1)
    for edge, count in ((300, 50), (1 << 20, 10**9), (1 << 40, 10**12)):
        x = spread.integers(-edge, edge, (6, 5))
        sums = [int(spread.integers(0, edge)) * count + 7 for _ in range(5)]
        expected = [sum((count * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
        assert _deviations(x, count, np.array([s // count for s in sums]), [s % count for s in sums]) == expected


def test_huge_entries_count_as_the_edge_of_longs(spark):
    rows = whitened(frame(spark, [[3e38, 1.0], [-3e38, 2.0], [0.0, 3.0]])).collect()
    assert len(rows) == 6 and whitening.COMPONENTS == 8
