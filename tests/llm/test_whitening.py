import math

import numpy as np
import pytest

from tillmart.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, component int, n string, whitened double"


def table(spark, tmp_path, rows):
    extra = [(i, v, 1, "x", 0.5) for i, v in rows]
    spark.createDataFrame(extra, SCHEMA).repartition(3).write.mode("overwrite").parquet(
        f"{tmp_path}/embeddings.parquet"
    )
    return whitening.op11_whitening(spark, str(tmp_path)).collect()


def integers(v):
    return [math.floor(1024 * c) + 100_000 for c in v]


def check(rows, found, k=8):
    """Compare with numpy's eigenvectors over exact integers."""
    kept = [(i, integers(v)) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(kept), len(kept[0][1])
    sums = [sum(x[j] for _, x in kept) for j in range(d)]
    centred = np.array([[(n * x[j] - sums[j]) / n for j in range(d)] for _, x in kept])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    rank = int((values > values.max() * 1e-11).sum())
    values, vectors = values[::-1][:rank], vectors[:, ::-1][:, :rank]
    m = min(k, rank)
    assert len(found) == n * m
    deviations = sorted(
        (i is None, i or 0, min(sum((n * a - b) ** 2 for a, b in zip(x, sums, strict=True)), 2**63 - 1))
        for i, x in kept
    )
    assert deviations == sorted(
        (r.vec_id is None, r.vec_id or 0, r.deviation) for r in found if r.component == 1
    )
    for c in range(1, m + 1):
        mine = [r for r in found if r.component == c]
        assert {r.n for r in mine} == {n}
        share = values[c - 1] / np.trace(centred.T @ centred / n)
        assert all(abs(r.explained / share - 1) < 1e-9 for r in mine)
        assert all(r.identity_error < 1e-9 for r in mine)
    return centred, values, vectors, kept


def test_equals_numpy(spark, tmp_path):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(12, 12)) * np.array([1, 1, 1, 0.5, 0.5, 2, 0.1, 0.1, 3, 1, 1, 1])
    rows = [(i, (rng.normal(size=12) @ mix + 40).tolist()) for i in range(700)]
    found = table(spark, tmp_path, rows)
    centred, values, vectors, kept = check(rows, found)
    places = {i: at for at, (i, _) in enumerate(kept)}
    for c in range(1, 9):
        expected = centred @ vectors[:, c - 1] / math.sqrt(values[c - 1])
        got = np.zeros(len(kept))
        for r in found:
            if r.component == c:
                got[places[r.vec_id]] = r.whitened
        assert min(np.abs(got - expected).max(), np.abs(got + expected).max()) < 1e-8


def test_odd_rows(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(40)] + [(7, [1.0, 2.0, 3.0])] * 3
    rows += [(100, None), (101, [nan, 0.0, 0.0]), (102, [0.0, inf, 0.0]), (103, [None, 1.0, 1.0]),
             (None, [0.5, -0.5, 9.0])]
    check(rows, table(spark, tmp_path, rows))


def test_lengths_are_spaces_of_their_own(spark, tmp_path):
    rng = np.random.default_rng(5)
    short = [(i, rng.normal(size=2).tolist()) for i in range(30)]
    long = [(100 + i, rng.normal(size=5).tolist()) for i in range(50)]
    found = table(spark, tmp_path, [*short, *long, (200, [])])
    check(short, [r for r in found if r.vec_id < 100])
    check(long, [r for r in found if r.vec_id >= 100])


def test_large_entries_stay_exact(spark, tmp_path):
    rows = [(i, [float(2**40 + i * 2**20), float(i * i), -3.0 * i]) for i in range(30)]
    found = table(spark, tmp_path, rows)
    check(rows, found)
    beyond = [*rows, (90, [1e300, 0.0, 0.0]), (91, [0.0, 2.0**53, 0.0])]
    assert len(table(spark, tmp_path, beyond)) == len(found)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None), (2, [])]])
def test_nothing_to_spread(spark, tmp_path, rows):
    assert table(spark, tmp_path, rows) == []


def test_directions_without_spread(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(i, [a, 2 * a, 0.25, b]) for i, (a, b) in enumerate((rng.integers(-9, 9, (60, 2)) / 8).tolist())]
    found = table(spark, tmp_path, rows)
    check(rows, found)
    assert {r.component for r in found} == {1, 2}


def test_merging_states_equals_one_state():
    rng = np.random.default_rng(7)
    x = rng.integers(99_000, 101_000, (5000, 6))
    whole = whitening.Moments.of(x)
    parts = whitening.Moments.of(x[:1])
    for a, b in ((1, 700), (700, 701), (701, 5000)):
        parts = parts + whitening.Moments.of(x[a:b])
    assert parts.n == whole.n and (parts.sums == whole.sums).all()
    np.testing.assert_allclose(parts.scatter, whole.scatter, rtol=1e-12, atol=1e-12 * np.trace(whole.scatter))


def test_small_eigenvalues_keep_their_digits():
    scales = 10.0 ** -np.arange(8)
    a = np.outer(scales, scales) * (np.eye(8) + 0.3)
    columns = whitening.one_sided_jacobi(whitening.pivoted_cholesky(a))
    got = np.sort(np.einsum("ij,ij->j", columns, columns))
    assert abs(np.prod(got) / (np.prod(scales) ** 2 * (1 + 8 * 0.3)) - 1) < 1e-9
