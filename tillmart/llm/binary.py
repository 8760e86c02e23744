"""Token ids as binary blocks with Elias-Fano encoded document boundaries.

Documents are range-partitioned and sorted by id. A partition writes blocks; a block is
one row of a Parquet table, so that any store Spark writes to will do and a lost task is
written again under Spark's own commit. The payload stands by itself:

* header: magic, version, bytes per id, documents, ids, low bits (little-endian);
* low bits of the cumulative boundaries, packed;
* high bits in unary;
* a select directory: the position of every ``SAMPLED``-th one bit;
* the concatenated ids, 16 bits each if the vocabulary allows, else 32.

A boundary is found by one directory entry and a count of ones in between: about
2 + log2(ids / documents) bits per document and no table of 64-bit offsets.

Defined results: a null text is empty and holds its end id alone; rows without an id
come first; rows that share an id follow by the order of a hash of their text.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import (
    Columns, map_rows, materialize, only, scratch_path, shared_or_broadcast, table,
)
from .tokens import encode_all

END_ID = 2
# A block is closed when it holds this many ids; a longer document is a block.
BLOCK_IDS = 1 << 20
SAMPLED = 64
_MAGIC = b"TEF1"
_HEADER = struct.Struct("<4sBBBxQQ")  # magic, version, id bytes, low bits, documents, ids


@dataclass
class EliasFano:
    """A growing sequence of non-negative integers and constant-time access to it."""

    count: int
    low_bits: int
    low: np.ndarray  # packed bits
    high: np.ndarray  # packed bits, unary
    directory: np.ndarray  # position of every SAMPLED-th one

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        """Encode sorted ``values``, none above ``universe``."""
        n = len(values)
        low_bits = max(0, int(universe // max(1, n)).bit_length() - 1)
        values = values.astype(np.uint64)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        high[ones] = 1
        return cls(n, low_bits, low, np.packbits(high, bitorder="little"), ones[::SAMPLED].astype("<u4"))

    def select(self, i: int) -> int:
        """Value number ``i``."""
        skipped = i % SAMPLED
        at = int(self.directory[i // SAMPLED])
        if skipped:
            byte = at // 8
            bits = np.unpackbits(self.high[byte : byte + 16], bitorder="little")
            bits[: at % 8 + 1] = 0
            ones = np.flatnonzero(bits)
            while len(ones) < skipped:
                skipped -= len(ones)
                byte += 16
                ones = np.flatnonzero(np.unpackbits(self.high[byte : byte + 16], bitorder="little"))
            at = byte * 8 + int(ones[skipped - 1])
        return ((at - i) << self.low_bits) | self._low(np.array([i]))[0]

    def _low(self, places: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(places), dtype=np.int64)
        bits = places[:, None] * self.low_bits + np.arange(self.low_bits)
        values = (self.low[bits >> 3] >> (bits & 7)) & 1
        return values.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def all(self) -> np.ndarray:
        """Every value, for sequential reading."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.count]
        places = np.arange(self.count)
        return ((ones - places) << self.low_bits) | self._low(places)


def encode_block(documents: list[np.ndarray], wide: bool) -> bytes:
    """The payload of a block of documents."""
    lengths = np.array([len(d) for d in documents], dtype=np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    bounds = EliasFano.encode(ends, total)
    kind = "<u4" if wide else "<u2"
    ids = np.concatenate(documents).astype(kind) if documents else np.zeros(0, kind)
    parts = [bounds.low.tobytes(), bounds.high.tobytes(), bounds.directory.tobytes()]
    head = _HEADER.pack(_MAGIC, 1, 4 if wide else 2, bounds.low_bits, len(documents), total)
    sizes = struct.pack("<3Q", *map(len, parts))
    return b"".join([head, sizes, *parts, ids.tobytes()])


def decode_block(payload: bytes) -> tuple[EliasFano, np.ndarray]:
    """Boundaries and ids of a block."""
    magic, version, width, low_bits, count, total = _HEADER.unpack_from(payload)
    if magic != _MAGIC or version != 1:
        raise ValueError("not a block of token ids")
    sizes = struct.unpack_from("<3Q", payload, _HEADER.size)
    at, parts = _HEADER.size + 24, []
    for size, kind in zip(sizes, (np.uint8, np.uint8, np.dtype("<u4")), strict=True):
        parts.append(np.frombuffer(payload, kind, size // np.dtype(kind).itemsize, at))
        at += size
    ids = np.frombuffer(payload, "<u4" if width == 4 else "<u2", total, at)
    return EliasFano(count, low_bits, *parts), ids


def read_document(payload: bytes, i: int) -> np.ndarray:
    """Ids of document number ``i`` of a block, without reading the others."""
    bounds, ids = decode_block(payload)
    return ids[bounds.select(i - 1) if i else 0 : bounds.select(i)]


_BLOCK = "shard int, block int, n_ids long, doc_ids array<long>, payload binary"


def write_blocks(docs: DataFrame, path: str, target: str, end_id: int, vocabulary: int) -> None:
    """Encode ``docs`` in ascending order of id and write the blocks to ``target``."""
    wide = max(vocabulary, end_id + 1) > 1 << 16
    ordered = (
        only(docs, "doc_id", "text")
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    schema = pa.schema(
        [("shard", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()),
         ("doc_ids", pa.list_(pa.int64())), ("payload", pa.binary())]
    )
    end = np.array([end_id], dtype="<u4")

    def run(batches):
        from pyspark import TaskContext

        shard, made = TaskContext.get().partitionId(), 0
        doc_ids: list = []
        documents: list[np.ndarray] = []
        held = 0

        def block() -> pa.RecordBatch:
            row = ([shard], [made], [held], [doc_ids], [encode_block(documents, wide)])
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t.type) for v, t in zip(row, schema, strict=True)], schema=schema
            )

        for batch in batches:
            encoded = encode_all(path, False, batch.column(1).to_pylist())
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                doc_ids.append(doc_id)
                documents.append(np.concatenate([ids, end]))
                held += len(ids) + 1
                if held >= BLOCK_IDS:
                    yield block()
                    made, held, doc_ids, documents = made + 1, 0, [], []
        if documents:
            yield block()

    ordered.mapInArrow(run, _BLOCK).write.parquet(target)


def read_blocks(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32, ids of each document."""
    blocks = spark.read.parquet(target)
    # One row per shard, as many as the writing job had tasks; then one per block.
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocks.select("shard", "block", "n_ids")
        .withColumn("block_start", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
        .join(shards, "shard")
        .select("shard", "block", (F.col("shard_start") + F.col("block_start")).alias("first"))
    )
    starts, count = materialize(starts, "block-starts")

    def work(c: Columns) -> Columns:
        out: Columns = {k: [] for k in ("shard", "block", "doc_id", "within", "n_tokens", "ids")}
        for shard, block, doc_ids, payload in zip(
            c["shard"], c["block"], c["doc_ids"], c["payload"], strict=True
        ):
            bounds, ids = decode_block(payload)
            ends = bounds.all()
            begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            for doc_id, a, b in zip(doc_ids, begins.tolist(), ends.tolist(), strict=True):
                row = (shard, block, doc_id, a, b - a, ids[a:b].astype("<u4").tobytes())
                for name, value in zip(out, row, strict=True):
                    out[name].append(value)
        return out

    read = map_rows(
        blocks.select("shard", "block", "doc_ids", "payload"),
        "shard int, block int, doc_id long, within long, n_tokens long, ids binary",
        work,
    ).withColumn("ids_crc32", F.crc32("ids"))  # before the join, which then needs no ids
    return read.join(shared_or_broadcast(starts, count), ["shard", "block"]).select(
        "doc_id", (F.col("first") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )


def op8_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundaries and checksum of every document, read back from the files."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    target = scratch_path(spark, "token-blocks")
    docs = table(spark, sf_dir, "documents")
    write_blocks(docs, path, target, END_ID, Tokenizer.from_file(path).get_vocab_size())
    return read_blocks(spark, target).select("doc_id", "start", "n_tokens", "ids_crc32")
