"""What the operators share: reading columns, batches of plain Python values, numbering."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import materialize, scratch_path, scratch_root  # noqa: F401

# Rows and bytes of one Arrow batch: texts can be long, so few at a time.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 * 1024 * 1024),
}

Columns = dict[str, list]


def tuned(spark: SparkSession) -> SparkSession:
    """Bound the batches that go to Python workers."""
    for name, value in BATCH.items():
        spark.conf.set(name, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, whatever else the table holds.

    Columns are taken by place, so extra ones may have any name, even one that
    differs only in case or that an operator uses itself.
    """
    places = {}
    for i, name in enumerate(df.columns):
        places.setdefault(name, i)
        places.setdefault(name.lower(), i)
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"c{places[n]}").alias(n) for n in names])


def map_rows(df: DataFrame, schema: str, work: Callable[[Columns], Columns]) -> DataFrame:
    """Apply ``work`` to batches, given and returned as lists by column."""
    kind = StructType.fromDDL(schema)
    target = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(work(batch.to_pydict()), schema=target)

    return df.mapInArrow(run, kind)


def map_whole(df: DataFrame, run) -> DataFrame:
    """Apply ``run`` to Arrow batches of all columns, which keep their names and types.

    Columns go by place on the way, since names may differ in case only.
    """
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return flat.mapInArrow(run, flat.schema).toDF(*df.columns)


def shared_or_broadcast(df: DataFrame, rows: int, most: int = 1_000_000) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are few; else Spark shuffles."""
    return F.broadcast(df) if rows <= most else df


class Taken:
    """Stretches of a text that are spoken for."""

    def __init__(self, spans: list[tuple[str, int, int]]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, a, b in sorted(spans, key=lambda s: s[1]):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(b, self.ends[-1])
            else:
                self.starts.append(a)
                self.ends.append(b)

    def add(self, a: int, b: int) -> bool:
        """Take ``a`` to ``b`` if it is free."""
        at = bisect_right(self.ends, a)
        if at < len(self.starts) and self.starts[at] < b:
            return False
        self.starts.insert(at, a)
        self.ends.insert(at, b)
        return True


def without(docs: DataFrame, gone: DataFrame, rows: int) -> DataFrame:
    """``docs`` without the rows whose ``doc_id`` is in ``gone`` (``doc_id``, ``rows`` rows).

    Columns keep their names and places, whatever they are called.
    """
    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    key = flat[f"c{docs.columns.index('doc_id')}"]
    gone = shared_or_broadcast(gone.select(F.col("doc_id").alias("gone")), rows)
    return flat.join(gone, key == F.col("gone"), "left_anti").toDF(*docs.columns)


def place_in_group(df: DataFrame, keys: list[str], order: list[str], salts: int) -> DataFrame:
    """Add ``place``: gapless from 0 within ``keys``, also when one group holds most rows.

    Groups are cut into ``salts`` parts by a hash of ``order``; each part is
    numbered by itself and moved by the counts of the parts before it. ``df`` is
    read twice, so it should be a stored table.
    """
    cut = df.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    parts = cut.groupBy(*keys, "salt").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy(*keys).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        *keys, "salt", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first")
    )
    inner = Window.partitionBy(*keys, "salt").orderBy(*order)
    numbered = cut.withColumn("within", F.row_number().over(inner) - 1)
    return (
        numbered.join(starts, [*keys, "salt"])
        .withColumn("place", (F.col("first") + F.col("within")).cast("long"))
        .drop("salt", "first", "within")
    )
