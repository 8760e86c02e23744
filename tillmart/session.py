"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Settings every job here relies on. Skewed joins are split by adaptive
# execution; broadcasts happen only below a size that Spark checks itself. That is the
# size of files, whose rows take ten to fifty times as much on the driver.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(4 * 1024 * 1024),
    # HotSpot does not compile longer methods; wide projections of text cleaning
    # run twice as fast when Spark splits them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Rows of more bytes than this are never broadcast by ``sided``. The driver needs a few
# times as much while it builds the table.
BROADCAST_BYTES = 80_000_000


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. A machine-local folder is
    acceptable only when the whole session runs on this machine.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tillmart-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write ``df`` to the shared folder once; return it re-read, and its row count.

    Re-reading gives Catalyst true file sizes, so it decides by itself whether
    the table is small enough to broadcast, and the count costs no second pass.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), int(seen.get.get("rows") or 0)


def sided(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` as the side of a join that is broadcast if its rows are small, else merged.

    The bytes of the rows with these columns are added up first; the size of files says
    little, as repeated texts and rising keys take next to none there.
    """
    texts = [f.name for f in df.schema if f.name in columns and isinstance(f.dataType, StringType)]
    # A row has a word for its place, one for its nulls and one per column; texts fill words.
    words = F.lit(2 + len(columns)).cast("bigint")
    for c in texts:
        words = words + F.coalesce(F.ceil(F.octet_length(c) / 8), F.lit(0))
    size = df.agg(F.sum(8 * words)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df.hint("merge")
