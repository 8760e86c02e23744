"""Exact top-k search by inner product over integer vectors.

Vectors are packed into tiles (a matrix and its ids per row). Every tile of rows
belongs to one lane; tiles of queries go to every lane. A task multiplies tiles,
keeps the best k of each query per tile and merges along its lane; lists of lanes
are then merged in a tree. No list is longer than k, no task holds more than two
tiles and the lists of one tile of queries.

Defined results: vectors that are null or hold a null or non-finite component, and
rows without an id, take no part. Products are formed only between vectors of the
same length. Rows that repeat a query's id count as the query itself. Ties go to the
smaller id. Scores beyond 64 bits are cut to the nearest 64-bit integer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import only, table

SCALE = 64.0
ROW_TILE, QUERY_TILE = 4096, 512
FAN_IN = 16
_EXACT = 2.0**53
_NONE = np.iinfo(np.int64).min
_TILES = "dim int, tile string, ids binary, data binary"


def _clean(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, ids, integer-valued matrix) of the valid rows of a batch."""
    ids, vectors = batch.column(0), batch.column(1)
    usable = np.asarray(ids.is_valid()) & np.asarray(vectors.is_valid())
    kept = np.flatnonzero(usable)
    if not len(kept):
        return
    ids = ids.take(pa.array(kept)).to_numpy(zero_copy_only=False).astype(np.int64)
    vectors = vectors.take(pa.array(kept))
    lengths = np.asarray(vectors.value_lengths())
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        matrix = flat[starts[rows, None] + np.arange(dim)] if dim else np.zeros((len(rows), 0))
        good = np.isfinite(matrix).all(axis=1)
        yield int(dim), ids[rows[good]], np.floor(SCALE * matrix[good])


def _pack(size: int, name: str):
    """Pack batches of (id, vector) into tiles of at most ``size`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        waiting: dict[int, list] = {}

        def tile(dim: int, group: list) -> pa.RecordBatch:
            nonlocal made
            made += 1
            ids = np.concatenate([g[0] for g in group])
            matrix = np.concatenate([g[1] for g in group])
            order = np.argsort(ids, kind="stable")
            return pa.RecordBatch.from_pydict(
                {
                    "dim": pa.array([dim], pa.int32()),
                    "tile": [f"{name}{part}-{made}"],
                    "ids": pa.array([ids[order].tobytes()], pa.binary()),
                    "data": pa.array([matrix[order].tobytes()], pa.binary()),
                }
            )

        for batch in batches:
            for dim, ids, matrix in _clean(batch):
                for at in range(0, len(ids), size):
                    group = waiting.setdefault(dim, [])
                    group.append((ids[at : at + size], matrix[at : at + size]))
                    if sum(len(g[0]) for g in group) >= size:
                        yield tile(dim, waiting.pop(dim))
        for dim, group in waiting.items():
            yield tile(dim, group)

    return run


def tiles(df: DataFrame, size: int, name: str) -> DataFrame:
    """Tiles of the (id, vector) rows of ``df``."""
    return df.mapInArrow(_pack(size, name), _TILES)


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    peak = max(np.abs(queries).max(initial=0), np.abs(rows).max(initial=0))
    if queries.shape[1] * peak * peak < _EXACT:
        return (queries @ rows.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(queries) @ whole(rows).T
    limits = np.iinfo(np.int64)
    return np.clip(exact, limits.min + 1, limits.max).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best k of each row of ``scores``; ``ids`` ascend, so earlier wins a tie."""
    n = scores.shape[1]
    if n > k:
        if np.abs(scores).max(initial=0) < 2**62 // n:
            key = scores * n + np.arange(n - 1, -1, -1)
            at = np.argpartition(key, n - k, axis=1)[:, n - k :]
        else:
            at = np.argsort(-scores.astype(object), axis=1, kind="stable")[:, :k]
        return np.take_along_axis(scores, at, axis=1), ids[at]
    return scores, np.broadcast_to(ids, scores.shape)


def _merge(a: tuple, b: tuple, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best k of two lists per query; ``_NONE``, which has no negative, comes last."""
    scores, ids = (np.concatenate([x, y], axis=1) for x, y in zip(a, b, strict=True))
    at = np.lexsort((ids, -scores, scores == _NONE), axis=1)[:, :k]
    return np.take_along_axis(scores, at, axis=1), np.take_along_axis(ids, at, axis=1)


def _partial(k: int):
    """Top lists of every run of tile pairs that share a tile of queries."""
    schema = pa.schema(
        [("query_id", pa.int64()), ("lane", pa.int32()),
         ("top", pa.list_(pa.struct([("lost", pa.int64()), ("vec_id", pa.int64())])))]
    )

    def flush(ids: np.ndarray, lane: int, best: tuple) -> pa.RecordBatch:
        scores, found = best
        real = scores != _NONE
        counts = real.sum(axis=1)
        struct = pa.StructArray.from_arrays(
            [pa.array(-scores[real]), pa.array(found[real])], ["lost", "vec_id"]
        )
        ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        top = pa.ListArray.from_arrays(ends, struct)
        lanes = pa.array(np.full(len(ids), lane, dtype=np.int32))
        return pa.RecordBatch.from_arrays([pa.array(ids), lanes, top], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, asked, best = None, None, None
        for batch in batches:
            for r in batch.to_pylist():
                key = (r["lane"], r["q_tile"])
                if key != current:
                    if current:
                        yield flush(asked, current[0], best)
                    current, best = key, None
                    asked = np.frombuffer(r["q_ids"], dtype=np.int64)
                    queries = np.frombuffer(r["q_data"]).reshape(len(asked), r["dim"])
                ids = np.frombuffer(r["ids"], dtype=np.int64)
                rows = np.frombuffer(r["data"]).reshape(len(ids), r["dim"])
                scores = _products(queries, rows)
                scores[asked[:, None] == ids] = _NONE
                found = _list(scores, ids, k)
                best = found if best is None else _merge(best, found, k)
        if current:
            yield flush(asked, current[0], best)

    def _list(scores, ids, k):
        # A row of the query's own id has the lowest score of all; where it would
        # be counted among the best, it is dropped when lists are written.
        own = (scores == _NONE).sum(axis=1).max(initial=0)
        if own and scores.shape[1] > k:
            scores = scores.copy()
            masked = scores == _NONE
            scores[masked] = scores[~masked].min(initial=0) - 1
            best = _best(scores, ids, k)
            floor = scores[masked].min()
            return np.where(best[0] == floor, _NONE, best[0]), best[1]
        return _best(scores, ids, k)

    return run


def exact_topk(queries: DataFrame, rows: DataFrame, k: int = 20, lanes: int = 0) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's best ``k`` rows.

    Both tables give (id, vector). ``lanes``: how many ways the rows are split, four
    per shuffle partition if not set.
    """
    spark = rows.sparkSession
    lanes = lanes or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = tiles(rows, ROW_TILE, "r").withColumn(
        "lane", F.pmod(F.xxhash64("tile"), F.lit(lanes)).cast("int")
    )
    asked = tiles(queries, QUERY_TILE, "q").select(
        "dim", F.col("tile").alias("q_tile"), F.col("ids").alias("q_ids"),
        F.col("data").alias("q_data"), F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"),
    )
    pairs = asked.join(shards, ["dim", "lane"]).sortWithinPartitions("lane", "q_tile")
    top = pairs.select(
        "dim", "lane", "q_tile", "q_ids", "q_data", "ids", "data"
    ).mapInArrow(
        _partial(k), "query_id long, lane int, top array<struct<lost: long, vec_id: long>>"
    )
    while True:
        lanes = -(-lanes // FAN_IN)
        top = (
            top.groupBy("query_id", (F.col("lane") / FAN_IN).cast("int").alias("lane"))
            .agg(F.flatten(F.collect_list("top")).alias("top"))
            .select("query_id", "lane", F.slice(F.array_sort("top"), 1, k).alias("top"))
        )
        if lanes == 1:
            break
    return top.select("query_id", F.posexplode("top").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"),
        F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.lost")).alias("score"),
    )


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best 20 rows for every vector whose id is divisible by 20, against all rows."""
    rows = only(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return exact_topk(rows.where("vec_id % 20 = 0"), rows, k=20)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
    CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
    AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
