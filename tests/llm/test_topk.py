import math

import pytest

from tillmart.llm import topk

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k):
    def valid(r):
        return r[0] is not None and r[1] is not None and all(
            x is not None and math.isfinite(x) for x in r[1]
        )

    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in filter(valid, rows)]
    out = set()
    for q, a in whole:
        if q % 20 == 0:
            scored = sorted(
                (-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b)
            )
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


def result(spark, rows, k=20, lanes=3):
    df = spark.createDataFrame(rows, SCHEMA)
    return {tuple(r) for r in topk.exact_topk(df.where("vec_id % 20 = 0"), df, k, lanes).collect()}


def test_ties_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [(i % 7) / 8 - 0.3, 0.5, -0.25 * (i % 3)]) for i in range(90)]
    rows += [(100, None), (120, [nan, 0.0, 0.0]), (140, [inf, 0.0, 0.0]), (None, [0.1, 0.1, 0.1]),
             (160, [None, 1.0, 1.0]), (180, [0.5]), (181, [0.25]), (200, []), (203, [])]
    assert result(spark, rows) == brute(rows, 20)


def test_very_common_vector(spark):
    rows = [(i, [0.5, 0.5]) for i in range(300)] + [(301, [0.6, 0.6])]
    assert result(spark, rows, k=4) == brute(rows, 4)


def test_large_components_stay_exact(spark):
    rows = [(0, [3e7, 3e7]), (1, [3e7, 2.9e7]), (2, [-3e7, 1.0])]
    assert result(spark, rows) == brute(rows, 20)


def test_small_tiles_give_the_same(spark, monkeypatch):
    rows = [(i, [math.sin(i * j) for j in range(1, 9)]) for i in range(200)]
    monkeypatch.setattr(topk, "ROW_TILE", 16)
    monkeypatch.setattr(topk, "QUERY_TILE", 3)
    assert result(spark, rows, lanes=40) == brute(rows, 20)


def test_own_row_takes_no_place_in_a_merge(spark, monkeypatch):
    none = topk._NONE
    own, other = ([[none, 5]], [[0, 1]]), ([[9, 8]], [[2, 3]])
    for a, b in ((own, other), (other, own)):
        a, b = (tuple(topk.np.array(x, dtype="int64") for x in pair) for pair in (a, b))
        scores, ids = topk._merge(a, b, 2)
        assert (scores.tolist(), ids.tolist()) == ([[9, 8]], [[2, 3]])
    rows = [(i, [math.sin(i * j) for j in range(1, 9)]) for i in range(200)]
    monkeypatch.setattr(topk, "ROW_TILE", 7)
    for k in (7, 10, 20):
        assert result(spark, rows, k=k, lanes=1) == brute(rows, k)


def test_empty(spark):
    assert result(spark, []) == set()


@pytest.mark.parametrize("n", [1, 2])
def test_fewer_than_k(spark, n):
    rows = [(i, [1.0, 0.5]) for i in range(n)]
    assert result(spark, rows) == brute(rows, 20)
