"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

1. Every task reduces its vectors, scaled to integers, to count, exact sums and scatter
   about its own mean. Two such states merge without subtracting large products: the
   difference of their means comes from exact integers. Lanes, then one state per length.
2. The scatter is factored by pivoted Cholesky into a triangular factor whose columns
   one-sided Jacobi rotates until they are orthogonal. Their squared norms over n are the
   eigenvalues and the normalised columns the components, so no product of the factor
   with itself is ever formed and small eigenvalues keep their digits.
3. Rows are projected in a second pass and stored; the covariance of what was stored gives
   the identity error.

A task holds one block of rows and one scatter per distinct length; the driver holds means
and a few components per length, whatever the number of rows.

Defined results: vectors that are null, hold a null or non-finite entry, or an entry whose
integer exceeds 64 bits take no part. Vectors of each length are a space of their own with
its own fit. Rows without an id take part; rows that repeat are counted each time. A
direction without spread (pivots below rounding) has no component, so a single vector, or
vectors that are all equal or empty, give no rows. ``deviation`` beyond 64 bits is the
largest long. The largest entry of a component is positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, only, table

SCALE, SHIFT = 1024.0, 100_000
COMPONENTS = 8
BLOCK, LANES = 4096, 64
_LONGEST = 2**63 - 1
_SAFE = 2.0**62
_STATE = "lane int, dim int, n long, sums array<decimal(38,0)>, scatter binary"


@dataclass
class Moments:
    """Count, exact sums and scatter about the mean of integer vectors."""

    n: int
    sums: np.ndarray  # Python integers
    scatter: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        """Moments of the rows of ``x``."""
        n, peak = len(x), float(np.abs(x.astype(np.float64)).max(initial=0))
        small = 2.0 * n * peak < _SAFE
        whole = x if small else x.astype(object)
        sums = whole.sum(axis=0)
        centred = (n * whole - sums).astype(np.float64) / n
        return cls(n, sums.astype(object), centred.T @ centred)

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        apart = (self.sums * other.n - other.sums * self.n).astype(np.float64)
        apart /= float(self.n) * float(other.n)
        between = np.outer(apart, apart) * (float(self.n) * float(other.n) / n)
        return Moments(n, self.sums + other.sums, self.scatter + other.scatter + between)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray]]:
    """(ids, integers of equal length) of the valid rows, at most ``BLOCK`` at a time."""
    waiting: dict[int, list] = {}

    def block(dim: int) -> tuple[list, np.ndarray]:
        parts = waiting.pop(dim)
        return sum((p[0] for p in parts), []), np.concatenate([p[1] for p in parts])

    for batch in batches:
        kept = np.flatnonzero(np.asarray(batch.column(1).is_valid()))
        if not len(kept):
            continue
        ids, vectors = (batch.column(i).take(pa.array(kept)) for i in (0, 1))
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        for dim in np.unique(lengths[lengths > 0]).tolist():
            rows = np.flatnonzero(lengths == dim)
            with np.errstate(over="ignore", invalid="ignore"):
                scaled = np.floor(SCALE * flat[starts[rows, None] + np.arange(dim)])
            # Null entries are NaN here; neither they nor infinity are below the bound.
            good = (np.abs(scaled) < 2.0**63 - 2 * SHIFT).all(axis=1)
            if good.any():
                names = ids.take(pa.array(rows[good])).to_pylist()
                group = waiting.setdefault(dim, [])
                group.append((names, scaled[good].astype(np.int64) + SHIFT))
                if sum(len(g[0]) for g in group) >= BLOCK:
                    yield block(dim)
    for dim in list(waiting):
        yield block(dim)


def _state(lane: int, dim: int, m: Moments) -> pa.RecordBatch:
    sums = [Decimal(int(s)) for s in m.sums]
    return pa.RecordBatch.from_arrays(
        [pa.array([lane], pa.int32()), pa.array([dim], pa.int32()), pa.array([m.n], pa.int64()),
         pa.array([sums], pa.list_(pa.decimal128(38, 0))), pa.array([m.scatter.tobytes()], pa.binary())],
        names=["lane", "dim", "n", "sums", "scatter"],
    )


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, Moments]]:
    """(lane, length, moments) of stored states."""
    for batch in batches:
        for row in batch.to_pylist():
            sums = np.array([int(s) for s in row["sums"]], dtype=object)
            scatter = np.frombuffer(row["scatter"]).reshape(row["dim"], row["dim"])
            yield row["lane"], row["dim"], Moments(row["n"], sums, scatter)


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The moments of a task's vectors, one state per length."""
    from pyspark import TaskContext

    held: dict[int, Moments] = {}
    for _, x in blocks(batches):
        dim, part = x.shape[1], Moments.of(x)
        held[dim] = held[dim] + part if dim in held else part
    lane = TaskContext.get().partitionId() % LANES
    for dim, moments in held.items():
        yield _state(lane, dim, moments)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One state per length of all that reach a task."""
    held: dict[int, tuple[int, Moments]] = {}
    for lane, dim, part in _states(batches):
        held[dim] = (lane, held[dim][1] + part) if dim in held else (lane, part)
    for dim, (lane, moments) in held.items():
        yield _state(lane, dim, moments)


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``f`` with ``f @ f.T == a`` for positive semidefinite ``a``, one column per unit of rank.

    Row i of the triangle is row ``order[i]`` here: rows come back in their own places.
    """
    d = len(a)
    rest, order = a.copy(), np.arange(d)
    factor = np.zeros((d, d))
    least = d * np.finfo(float).eps * max(np.diag(a).max(initial=0.0), 0.0)
    for k in range(d):
        at = k + int(np.argmax(np.diag(rest)[k:]))
        if not rest[at, at] > least:
            factor = factor[:, :k]
            break
        swap, back = [k, at], [at, k]
        rest[swap], order[swap], factor[swap] = rest[back], order[back], factor[back]
        rest[:, swap] = rest[:, back]
        factor[k:, k] = rest[k:, k] / np.sqrt(rest[k, k])
        column = factor[k + 1 :, k]
        rest[k + 1 :, k + 1 :] -= np.outer(column, column)
    return factor[np.argsort(order)]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``factor`` times the rotations that make its columns orthogonal.

    Disjoint pairs of a round-robin tournament are rotated together.
    """
    work = np.array(factor.T)  # a row per column of the factor
    r = len(work)
    players = list(range(r + r % 2))
    tiny = max(factor.shape) * np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for _ in range(len(players) - 1):
            half = len(players) // 2
            pairs = [(a, b) for a, b in zip(players[:half], players[: half - 1 : -1], strict=True)
                     if a < r and b < r]
            players = [players[0], players[-1], *players[1:-1]]
            if not pairs:
                continue
            p, q = (np.array(side) for side in zip(*pairs, strict=True))
            x, y = work[p], work[q]
            alpha, beta, gamma = (np.einsum("ij,ij->i", u, v) for u, v in ((x, x), (y, y), (x, y)))
            far = np.abs(gamma) > tiny * np.sqrt(alpha * beta)
            if not far.any():
                continue
            turned = True
            p, q, x, y = p[far], q[far], x[far], y[far]
            zeta = (beta[far] - alpha[far]) / (2 * gamma[far])
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            s = c * t
            work[p], work[q] = c[:, None] * x - s[:, None] * y, s[:, None] * x + c[:, None] * y
        if not turned:
            break
    return work.T


@dataclass
class Whitening:
    """The fit of one vector length: ``components`` are rows, by falling eigenvalue."""

    n: int
    sums: np.ndarray  # Python integers
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @classmethod
    def of(cls, m: Moments, k: int) -> Whitening:
        """At most ``k`` components of the vectors behind ``m``."""
        columns = one_sided_jacobi(pivoted_cholesky(m.scatter))
        norms = np.sqrt(np.einsum("ij,ij->j", columns, columns))
        first = np.argsort(-norms, kind="stable")[:k]
        units = (columns[:, first] / norms[first]).T
        peaks = np.take_along_axis(units, np.abs(units).argmax(axis=1)[:, None], axis=1)
        return cls(m.n, m.sums, units * np.sign(peaks), norms[first] ** 2 / m.n,
                   float(np.trace(m.scatter)) / m.n)

    def project(self, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Whitened coordinates and exact deviations of the rows of ``x``."""
        peak = max(float(np.abs(x.astype(np.float64)).max(initial=0)),
                   float(np.abs(self.sums.astype(np.float64)).max(initial=0)) / self.n)
        small = 2.0 * self.n * peak < _SAFE
        whole = self.n * (x if small else x.astype(object)) - self.sums.astype(
            np.int64 if small else object
        )
        apart = whole.astype(np.float64)
        if not float(np.abs(apart).max(initial=0)) ** 2 * x.shape[1] < _SAFE:
            whole = whole.astype(object)
        deviations = [min(int(v), _LONGEST) for v in (whole * whole).sum(axis=1)]
        return apart / self.n @ self.components.T / np.sqrt(self.eigenvalues), deviations


def moments(vectors: DataFrame) -> DataFrame:
    """One state per vector length of (id, vector) rows."""
    lanes = vectors.mapInArrow(_reduce, _STATE).repartition(LANES, "lane").mapInArrow(_merge, _STATE)
    return lanes.repartition("dim").mapInArrow(_merge, _STATE)


def fit(vectors: DataFrame, k: int = COMPONENTS) -> dict[int, Whitening]:
    """The fits of (id, vector) rows by vector length.

    The factorisation runs in a task; what comes back is a mean and ``k`` components for
    each length.
    """

    def solve(batches):
        for _, dim, m in _states(batches):
            w = Whitening.of(m, k)
            yield pa.RecordBatch.from_pydict(
                {"dim": [dim], "n": [w.n], "sums": [[Decimal(int(s)) for s in w.sums]],
                 "components": [w.components.ravel().tolist()],
                 "eigenvalues": [w.eigenvalues.tolist()], "trace": [w.trace]},
                schema=fits,
            )

    fits = pa.schema(
        [("dim", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.decimal128(38, 0))),
         ("components", pa.list_(pa.float64())), ("eigenvalues", pa.list_(pa.float64())),
         ("trace", pa.float64())]
    )
    found = moments(vectors).mapInArrow(
        solve, "dim int, n long, sums array<decimal(38,0)>, components array<double>, "
        "eigenvalues array<double>, trace double",
    )
    return {
        row.dim: Whitening(
            row.n,
            np.array([int(s) for s in row.sums], dtype=object),
            np.array(row.components, dtype=float).reshape(len(row.eigenvalues), row.dim),
            np.array(row.eigenvalues, dtype=float),
            row.trace,
        )
        for row in found.collect()
    }


def whiten(vectors: DataFrame, fits: dict[int, Whitening]) -> DataFrame:
    """vec_id, dim, deviation and whitened coordinates of every valid (id, vector) row."""
    schema = pa.schema(
        [("vec_id", pa.int64()), ("dim", pa.int32()), ("deviation", pa.int64()),
         ("whitened", pa.list_(pa.float64()))]
    )

    def run(batches):
        for ids, x in blocks(batches):
            dim = x.shape[1]
            coordinates, deviations = fits[dim].project(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([dim] * len(ids), pa.int32()),
                 pa.array(deviations, pa.int64()),
                 pa.array(list(coordinates), pa.list_(pa.float64()))],
                schema=schema,
            )

    return vectors.mapInArrow(run, "vec_id long, dim int, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """dim, identity_error: largest entry of the whitened covariance minus the identity."""
    at = [F.get("whitened", F.lit(i)) for i in range(k)]
    entries = [
        F.abs(F.covar_pop(at[i], at[j]) - F.lit(float(i == j))) for i in range(k) for j in range(i, k)
    ]
    return whitened.groupBy("dim").agg(F.greatest(*entries, F.lit(None)).alias("identity_error"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of all embeddings."""
    vectors = only(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    fits = fit(vectors)
    stored, _ = materialize(whiten(vectors, fits), "whitened")
    shape = spark.createDataFrame(
        [
            (dim, w.n, (w.eigenvalues / w.trace).tolist() if w.trace else [])
            for dim, w in fits.items()
        ],
        "dim int, n long, shares array<double>",
    )
    # One row per vector length on the side of the fits.
    about = F.broadcast(shape.join(identity_error(stored), "dim"))
    return (
        stored.join(about, "dim")
        .select("*", F.posexplode("whitened").alias("at", "value"))
        .select(
            "vec_id",
            (F.col("at") + 1).alias("component"),
            "n",
            "deviation",
            F.col("value").alias("whitened"),
            F.get("shares", F.col("at")).alias("explained"),
            "identity_error",
        )
    )
