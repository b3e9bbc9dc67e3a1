"""Whitening against the eigenvectors of a dense covariance."""

import math

import numpy as np
import pytest
from blotter.llm import whitening
from blotter.llm.queries import op12_whitening
from hypothesis import given, settings
from hypothesis import strategies as st

EMBEDDINGS = "vec_id long, embedding array<float>, label int"


def solved(rows):
    values, vectors = whitening.singular(np.linalg.qr(rows, mode="r"))
    wide = rows.shape[1]
    expected = np.linalg.svd(rows, compute_uv=False) ** 2
    expected = np.pad(expected, (0, max(0, wide - len(expected))))[:wide]
    top = max(expected[0], 1.0)
    assert np.abs(values - expected).max() < 1e-12 * top
    assert np.abs(vectors.T @ vectors - np.eye(wide)).max() < 1e-10
    assert np.abs(rows.T @ rows @ vectors - vectors * values).max() < 1e-12 * top * len(rows)
    return values, expected


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 12), st.integers(1, 20), st.integers(0, 2**32 - 1))
def test_small_whole_numbers(wide, long, seed):
    solved(np.random.default_rng(seed).integers(-2, 3, size=(long, wide)).astype(float))


@pytest.mark.parametrize("gap", [1.0, 1e-3, 1e-6, 1e-9, 1e-12, 1e-15, 0.0])
def test_values_that_nearly_agree(gap):
    dice = np.random.default_rng(5)
    left, right = (np.linalg.qr(dice.normal(size=(n, 40)))[0] for n in (200, 40))
    solved(left @ np.diag(1 + gap * dice.random(40)) @ right)


def test_small_values_are_as_accurate_as_large_ones():
    dice = np.random.default_rng(6)
    values, expected = solved(dice.normal(size=(300, 30)) * np.logspace(0, -6, 30))
    assert (np.abs(values - expected) / expected).max() < 1e-12
    a, b = np.logspace(0, -40, 12), np.logspace(-1, -41, 11)
    found = np.sort(whitening.dqds(a * a, b * b))[::-1]
    # The product of all is the square of the determinant, whatever their sizes.
    assert math.isclose(np.log(found).sum(), 2 * np.log(a).sum(), rel_tol=1e-13)


def test_bidiagonal():
    r = np.triu(np.random.default_rng(7).normal(size=(9, 9)))
    a, b, right = whitening.bidiagonal(r)
    both = np.diag(a) + np.diag(b, 1)
    assert (a >= 0).all() and (b >= 0).all()
    assert np.allclose(r.T @ r, right @ both.T @ both @ right.T)


def expected_rows(vectors, components):
    """n, deviations, eigenvalues, whitened, explained."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = [[n * c - s for c, s in zip(row, sums)] for row in x]
    rows = np.array(centred, dtype=float) / n
    values, directions = np.linalg.eigh(rows.T @ rows / n)
    values, directions = values[::-1], directions[:, ::-1]
    kept = int((values[:components] > 1e-9 * values[0]).sum())
    parts = rows @ directions[:, :kept] / np.sqrt(values[:kept])
    return n, [sum(c * c for c in row) for row in centred], parts, values[:kept] / values.sum()


def compare(found, ids, vectors, components=32):
    n, deviations, parts, explained = expected_rows(vectors, components)
    by_row = {}
    for row in found:
        by_row.setdefault(row["vec_id"], []).append(row)
    assert len(found) == len(ids) * parts.shape[1]
    assert len({row["identity_error"] for row in found}) == 1 and found[0]["identity_error"] < 1e-9
    matrix = np.zeros(parts.shape)
    for k, vec_id in enumerate(ids):
        for row in by_row[vec_id]:
            assert row["n"] == n and row["deviation"] == deviations[k]
            assert math.isclose(row["explained"], explained[row["component"] - 1], rel_tol=1e-9)
            matrix[k, row["component"] - 1] = row["whitened"]
    signs = np.sign((matrix * parts).sum(axis=0))
    assert np.abs(matrix * signs - parts).max() < 1e-7


def test_query_against_a_dense_covariance(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    dice = np.random.default_rng(8)
    vectors = (dice.normal(size=(700, 40)) * np.linspace(1, 4, 40) + dice.normal(size=40) * 50).astype(np.float32)
    data = [(i, v.tolist(), None) for i, v in enumerate(vectors)]
    bad = [(1000, None, 1), (1001, [None] + [0.0] * 39, 1), (1002, [float("nan")] * 40, 1), (1003, [float("-inf")] * 40, 1),
           (1004, [3e38] * 40, 1)]
    path = f"{tmp_path}/embeddings.parquet"
    df = spark.createDataFrame(data + bad, EMBEDDINGS).selectExpr("*", "1 AS n", "2 AS component", "'x' AS x", "3 AS part")
    df.repartition(7).write.parquet(path)
    compare(op12_whitening(spark, str(tmp_path)).collect(), range(700), vectors)


def vectors_of(spark, data, parts=1):
    return spark.createDataFrame(data, "vec_id long, x array<long>").repartition(parts)


def test_no_rows_and_no_variance(spark):
    for data in ([], [(1, [5, 6])], [(1, [5, 6]), (2, [5, 6])], [(1, []), (2, [])]):
        vectors = vectors_of(spark, data)
        by = whitening.fit(vectors, 32)
        assert by.n == len(data) and by.explained == []
        assert whitening.identity_error(vectors, by) == 0
        assert [r["whitened"] for r in whitening.whitened(vectors, by).collect()] == [[]] * len(data)


def test_constant_entries_repeated_rows_and_null_ids(spark):
    data = [(None, [1, 7, 2]), (1, [3, 7, 1]), (1, [3, 7, 1]), (2, [-4, 7, 9]), (3, [0, 7])]
    vectors = vectors_of(spark, data, 3)
    by = whitening.fit(vectors, 32, missing=2)
    assert by.n == 5 and by.sums == [3, 35, 15] and by.directions.shape == (3, 2)
    rows = whitening.whitened(vectors, by).collect()
    assert len(rows) == 5 and sum(r["vec_id"] is None for r in rows) == 1
    parts = np.array([r["whitened"] for r in rows])
    assert np.allclose(parts.T @ parts / 5, np.eye(2)) and np.allclose(parts.sum(axis=0), 0)
    assert abs(sum(by.explained) - 1) < 1e-12
    assert whitening.identity_error(vectors, by) < 1e-12


def test_numbers_near_the_ends_of_a_long(spark):
    far = 1 << 61
    data = [(k, [far - k * k, -far + 3 * k, k]) for k in range(6)] + [(6, [-far, far, 7])]
    vectors = vectors_of(spark, data, 2)
    by = whitening.fit(vectors, 1)
    assert by.sums == [sum(v[k] for _, v in data) for k in range(3)]
    for row in whitening.whitened(vectors, by).collect():
        x = dict(data)[row["vec_id"]]
        exact = sum((7 * c - s) ** 2 for c, s in zip(x, by.sums))
        assert row["deviation"] is None if exact >= 10**38 else int(row["deviation"]) == exact
    assert whitening.identity_error(vectors, by) < 1e-9


def test_too_wide(spark, monkeypatch):
    monkeypatch.setattr(whitening, "WIDEST", 4)
    with pytest.raises(ValueError):
        whitening.fit(vectors_of(spark, [(1, [1, 2, 3, 4, 5])]), 2)
    assert whitening.fit(vectors_of(spark, [(1, [1, 2, 3, 4]), (2, [0, 0, 0, 1])]), 2).n == 2


def test_components_are_the_first_ones(spark):
    dice = np.random.default_rng(9)
    data = [(k, dice.integers(-9, 10, 6).tolist()) for k in range(50)]
    vectors = vectors_of(spark, data, 3)
    whole, part = whitening.fit(vectors, 6), whitening.fit(vectors, 2)
    assert np.allclose(np.abs(whole.directions[:, :2]), np.abs(part.directions))
    assert np.allclose(part.explained, whole.explained[:2]) and part.explained[0] >= part.explained[1]
