"""Whitening, and the counts and vectors of a spectrum."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from souk.llm import queries, spectrum, whitening

SCHEMA = "vec_id long, embedding array<double>, component string, n string, size int"


def symmetric(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    out = q * np.asarray(values, float) @ q.T
    return (out + out.T) / 2


@pytest.mark.parametrize("seed", range(20))
def test_pivots_count_negative_eigenvalues(seed):
    draw = np.random.default_rng(seed)
    size = int(draw.integers(1, 40))
    matrix = draw.standard_normal((size, size))
    matrix = matrix + matrix.T
    if seed % 2:
        np.fill_diagonal(matrix, 0)  # no single pivot to start with
    values = np.linalg.eigvalsh(matrix)
    for shift in [0.0, 1.0, *((values[1:] + values[:-1]) / 2)]:
        found = spectrum.negatives(matrix - shift * np.eye(size))
        assert found == int((values < shift).sum())


@pytest.mark.parametrize("values", [
    [5, 4, 3, 2, 1], [1], [1e9, 1, 1e-3], [3, 3, 3, 3], [7, 2, 2, 2, 1, 1], [4, 0, 0],
    [1, 1 - 1e-9, 1 - 2e-9, 0.5], list(np.geomspace(1e6, 1, 64)), [2] * 40,
])
def test_leading_values_and_vectors(values):
    matrix = symmetric(values)
    found, vectors = spectrum.leading(matrix, 32)
    wanted = sorted((v for v in values if v > 0), reverse=True)[:32]
    assert np.allclose(found, wanted, rtol=1e-9, atol=1e-12 * max(values))
    assert np.allclose(vectors.T @ vectors, np.eye(len(wanted)), atol=1e-6)
    assert np.allclose(matrix @ vectors, vectors * found, atol=1e-10 * max(values))


def test_nothing_to_find():
    for size in (0, 1, 3):
        values, vectors = spectrum.leading(np.zeros((size, size)), 5)
        assert len(values) == 0 and vectors.shape == (size, 0)


def brute(vectors, most=32):
    """Whole vectors to n, deviations, values and (absolute) whitened rows."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[c - s / n for c, s in zip(row, sums)] for row in x])
    covariance = centred.T @ centred / n
    values, found = np.linalg.eigh(covariance)
    values, found = values[::-1][:most], found[:, ::-1][:, :most]
    kept = values > 1e-9 * values[0]
    white = np.abs(centred @ found[:, kept] / np.sqrt(values[kept]))
    return n, deviations, values[kept] / np.trace(covariance), white


def check(rows, vectors, ids):
    n, deviations, explained, white = brute(vectors)
    assert len(rows) == len(ids) * len(explained)
    at = {(r.vec_id, r.component): r for r in rows}
    for i, name in enumerate(ids):
        for k in range(len(explained)):
            r = at[name, k + 1]
            assert (r.n, r.deviation) == (n, deviations[i])
            assert r.explained == pytest.approx(explained[k], rel=1e-6)
            assert abs(r.whitened) == pytest.approx(white[i, k], abs=1e-6)
            assert 0 <= r.identity_error <= 1e-6


def test_query_on_its_table(spark, sf_dir):
    rows = queries.op12_embedding_whitening(spark, sf_dir).collect()
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    good = [r for r in table if r.embedding is not None and all(
        c is not None and math.isfinite(c) for c in r.embedding)]
    check(rows, [r.embedding for r in good], [r.vec_id for r in good])
    # One sign per component for all rows: whitened columns are uncorrelated.
    white = np.zeros((len(good), 32))
    place = {r.vec_id: i for i, r in enumerate(good)}
    for r in rows:
        white[place[r.vec_id], r.component - 1] = r.whitened
    assert np.allclose(white.T @ white / len(good), np.eye(32), atol=1e-6)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(3)


def found(spark, rows):
    vectors = table(spark, rows)
    return whitening.components(vectors, whitening.fit(vectors)).collect()


def test_unusable_vectors_take_no_part(spark):
    draw = np.random.default_rng(3)
    good = [(i, draw.standard_normal(4).tolist()) for i in range(30)]
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [float("nan"), 0.0, 0.0, 0.0]),
           (103, [float("inf"), 0.0, 0.0, 0.0]), (104, [1e300, 0.0, 0.0, 0.0])]
    check(found(spark, good + bad), [v for _, v in good], [i for i, _ in good])


def test_each_length_is_a_fit_of_its_own(spark):
    draw = np.random.default_rng(4)
    short = [(i, draw.standard_normal(2).tolist()) for i in range(9)]
    long = [(i + 50, draw.standard_normal(5).tolist()) for i in range(12)]
    rows = found(spark, [*short, *long, (99, []), (98, [1.0, 2.0, 3.0])])
    check([r for r in rows if r.vec_id < 50], [v for _, v in short], [i for i, _ in short])
    check([r for r in rows if 50 <= r.vec_id < 90], [v for _, v in long], [i for i, _ in long])
    assert all(r.vec_id < 90 for r in rows)  # empty, or alone of its length: no variance


def test_repeated_rows_equal_rows_and_none(spark):
    rows = found(spark, [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [0.0, 0.0])])
    assert sorted((r.vec_id or 0, r.component) for r in rows) == [(0, 1), (1, 1), (1, 1)]
    assert {r.n for r in rows} == {3}
    assert found(spark, [(1, [2.0, 2.0])] * 5) == []
    assert found(spark, []) == []


def test_large_entries_stay_exact(spark):
    rows = [(i, [1e9 + i, -1e9 + 3 * i]) for i in range(8)]
    for r in found(spark, rows):
        assert r.deviation == brute([v for _, v in rows])[1][r.vec_id]
    huge = [(i, [(-1) ** i * 1e15]) for i in range(4)]
    assert [r.deviation for r in found(spark, huge)] == [None] * 4


def test_arrays_of_whitened(spark):
    draw = np.random.default_rng(5)
    vectors = table(spark, [(i, draw.standard_normal(3).tolist()) for i in range(20)])
    fits = whitening.fit(vectors, most=2)
    arrays = {r.vec_id: r.whitened for r in whitening.whiten(vectors, fits).collect()}
    for r in whitening.components(vectors, fits).collect():
        assert arrays[r.vec_id][r.component - 1] == r.whitened


def test_no_group_holds_a_page_of_every_task(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").repartition(60)
    rows = vectors.select(F.col("embedding").cast("array<double>").alias("vector"))
    once = whitening._sums(rows)
    assert once == whitening._sums(rows.repartition(7))
