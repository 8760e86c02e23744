"""The corpus pipeline: from raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillmart.llm import decontaminate, neardup, packing, private, toxicity
from tillmart.llm.common import scratch_path, table, tuned


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    tuned(spark)
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    tuned(spark)
    return neardup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    tuned(spark)
    return private.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 ids and their places in sequences."""
    import public_tokenizers

    tuned(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal data", hide_private),
    ("packing", pack),
]

# The stages learn models and compare sets of words; SQL cannot express them. Tests hold
# near duplicates, decontamination, base spans and packing against plain versions of the
# operators; toxicity is measured by held-out accuracy.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
