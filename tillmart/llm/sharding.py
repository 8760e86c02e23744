"""Balanced shards by vector bin packing.

Groups of equal texts are weighed by bytes, tokens and rows. A group that weighs a
good part of a shard is a unit by itself and, beyond ``1 / PARTS`` of a shard, is
cut by a hash of its ids; all lighter groups fall into ``BUCKETS`` units by a hash
of their text, so equal texts stay together. The number of units is bounded by the
number of shards, not by the data. Each unit, heaviest first, goes to the shard whose
residual capacity has the highest dot product with it.

Defined results: a null text has no bytes and counts as equal to other nulls; rows
without an id are ordinary rows; rows that repeat id and text stay together. A text
longer than a shard's share makes its shard that much larger.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, only, place_in_group, table

SHARDS = 24
BUCKETS = 4096
# A group over this part of a shard's bytes or rows is weighed by itself and cut.
PARTS = 64
SALTS = 256
OVERHEAD = 8
# Importance of bytes, tokens and rows. The shards obey the law of equal bytes, so
# bytes lead; tokens and rows decide among shards that are alike in bytes.
IMPORTANCE = np.array([16.0, 1.0, 1.0]) / 18


def weighed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key`` and the weights ``size``, ``tokens`` of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return only(docs, "doc_id", "text").select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.regexp_count(text, F.lit(r"\S+")).cast("long").alias("tokens"),
    )


def place_units(weights: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unit: heaviest first, where capacity left fits it best."""
    total = np.maximum(weights.sum(axis=0), 1)
    weights = weights / total
    left = np.full((shards, weights.shape[1]), 1.0 / shards)
    placed = np.zeros(len(weights), dtype=np.int64)
    for i in np.argsort(-(weights @ IMPORTANCE), kind="stable"):
        at = int(np.argmax((left * IMPORTANCE) @ weights[i]))
        placed[i] = at
        left[at] -= weights[i]
    return placed


def _piece(doc_id: str):
    """Unit of a row of a large group."""
    return F.col("first_unit") + F.pmod(F.xxhash64(doc_id, "text_key"), F.col("pieces"))


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` (with ``doc_id`` and ``text``) and a column ``shard`` from 0.

    Reads the texts once for the weights, once for the pieces of large groups and once
    for the result; no text moves.
    """
    spark = docs.sparkSession
    sums = [F.sum(c).alias(c) for c in ("size", "tokens", "rows")]
    per_text = (
        weighed(docs)
        .groupBy("text_key")
        .agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"),
             F.count(F.lit(1)).alias("rows"))
    )
    groups, _ = materialize(per_text, "shard-groups")
    total = groups.agg(*sums).first()
    size, rows = (total["size"] or 0) / shards, (total["rows"] or 0) / shards
    large = (F.col("size") > size / PARTS) & (F.col("rows") > 1)
    large = large | ((F.col("rows") > rows / PARTS) & (F.col("rows") > 1))
    # At most 2 * shards * PARTS groups can be that large, so these lists are bounded.
    heavy = groups.where(large).orderBy("text_key").collect()
    light = (
        groups.where(~large)
        .groupBy(F.pmod("text_key", F.lit(BUCKETS)).alias("unit"))
        .agg(*sums)
        .orderBy("unit")
        .collect()
    )
    units = [(r["unit"], r["size"], r["tokens"], r["rows"]) for r in light]
    cuts = []
    first = BUCKETS
    for r in heavy:
        share = max(r["size"] / max(size, 1), r["rows"] / max(rows, 1))
        pieces = int(min(r["rows"], max(1, np.ceil(share * PARTS / 4))))
        cuts.append((r["text_key"], first, pieces))
        first += pieces
    cut_table = spark.createDataFrame(cuts, "text_key long, first_unit long, pieces long")
    if cuts:  # what the pieces of large groups weigh; rows without an id share one piece
        pieces = weighed(docs).join(F.broadcast(cut_table), "text_key").withColumn("rows", F.lit(1))
        measured = pieces.groupBy(_piece("doc_id").alias("unit")).agg(*sums).collect()
        units += [(r["unit"], r["size"], r["tokens"], r["rows"]) for r in measured]
    weights = np.array([u[1:] for u in units], dtype=float).reshape(-1, 3)
    placed = place_units(weights, shards)
    homes = spark.createDataFrame(
        [(int(u[0]), int(s)) for u, s in zip(units, placed, strict=True)], "unit long, shard int"
    )
    # Columns go by place on the way: extra ones may have any name.
    flat = [f"c{i}" for i in range(len(docs.columns))]
    doc_id, text = (flat[docs.columns.index(n)] for n in ("doc_id", "text"))
    unit = F.coalesce(_piece(doc_id), F.pmod("text_key", F.lit(BUCKETS)))
    return (
        docs.toDF(*flat)
        .withColumn("text_key", F.xxhash64(text))
        .join(F.broadcast(cut_table), "text_key", "left")
        .withColumn("unit", unit)
        .join(F.broadcast(homes), "unit")
        .select(*flat, "shard")
        .toDF(*docs.columns, "shard")
    )


def write_shards(assigned: DataFrame, path: str) -> None:
    """Write one folder per shard."""
    spread = assigned.hint("rebalance", "shard")
    spread.write.partitionBy("shard").mode("overwrite").parquet(path)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes, tokens and rows."""
    docs = only(table(spark, sf_dir, "documents"), "doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    thin = assign_shards(docs).select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        "shard",
    )
    stored, _ = materialize(thin, "shard-rows")
    placed = place_in_group(stored, ["shard"], ["doc_id", "text_crc32"], SALTS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("place").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
