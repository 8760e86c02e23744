"""Structural and statistical profile of a dataset, in long form."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import rounded
from .cleanse import union_files
from .numbering import running_total
from .quality import datetime_columns, long_format, numeric_columns


def _percent(part: str, whole: str):
    ratio = 100 * F.col(part).cast("double") / F.nullif(F.col(whole).cast("double"), F.lit(0.0))
    return F.coalesce(rounded(ratio), F.lit(0.0))


def profile_columns(df: DataFrame) -> DataFrame:
    """Type, nulls and distinct values of every column.

    The table is turned into (column, value) rows so that one distinct count
    serves all columns and repeated values merge before the shuffle.
    """
    cells = long_format(
        df, {c: F.col(c).cast("string") for c in df.columns}, [], "column_name", "value"
    )
    types = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    counted = cells.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("value").isNull()).alias("null_count"),
        F.count_distinct("value").alias("distinct_count"),
    )
    return counted.select(
        "column_name",
        F.element_at(types, F.col("column_name")).alias("dtype"),
        "null_count",
        _percent("null_count", "rows").alias("null_percent"),
        "distinct_count",
        _percent("distinct_count", "rows").alias("distinct_percent"),
    )


def profile_duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    counted = copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )
    return counted.select(
        "rows", "duplicate_rows", _percent("duplicate_rows", "rows").alias("duplicate_percent")
    )


def profile_numeric(df: DataFrame) -> DataFrame:
    """Range, mean, exact median and sign counts of every numeric column.

    Everything is read off one table of (column, value, copies). The median is
    the value at which the running number of copies passes the middle.
    """
    numbers = {c: F.col(c).cast("double") for c in numeric_columns(df.schema)}
    cells = long_format(df, numbers, [], "column_name", "value").filter("value IS NOT NULL")
    copies = cells.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("copies"))
    counted = running_total(
        copies, within=["column_name"], order_by=["value"], weight=F.col("copies"), output="upto"
    )
    value, n = F.col("value"), F.col("copies")
    sized = counted.groupBy("column_name").agg(F.sum("copies").alias("n"))
    # Bounded: one row per column.
    ranked = counted.join(F.broadcast(sized), "column_name")
    exact = value.try_cast("decimal(28,6)")
    middle_low, middle_high = F.floor((F.col("n") + 1) / 2), F.floor((F.col("n") + 2) / 2)
    # Sums run over decimals so they are exact; values beyond decimals fall back to doubles.
    total = F.when(
        F.count(exact) == F.count(value), F.try_sum(exact * n).cast("double")
    )
    return ranked.groupBy("column_name").agg(
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        rounded(F.coalesce(total, F.sum(value * n)) / F.sum(n), 4).alias("mean"),
        rounded(
            (
                F.min(F.when(F.col("upto") >= middle_low, value))
                + F.min(F.when(F.col("upto") >= middle_high, value))
            )
            / 2,
            4,
        ).alias("median"),
        F.sum(F.when(value < 0, n).otherwise(0)).alias("negative_values"),
        F.sum(F.when(value == 0, n).otherwise(0)).alias("zero_values"),
    )


def profile_dates(df: DataFrame) -> DataFrame:
    """First and last timestamp of every timestamp column with values."""
    stamps = {c: F.col(c).cast("timestamp_ntz") for c in datetime_columns(df.schema)}
    cells = long_format(df, stamps, [], "column_name", "value").filter("value IS NOT NULL")
    return cells.groupBy("column_name").agg(
        F.min("value").alias("min_date"), F.max("value").alias("max_date")
    )


def profile_dataset(df: DataFrame, dataset: str) -> DataFrame:
    """All figures of one dataset as (dataset, column, metric, value, text).

    Numbers are in ``value``; types and timestamps are in ``text``.
    """

    def figures(part: DataFrame, *metrics: str, kind: str = "double") -> DataFrame:
        column = F.col("column_name") if "column_name" in part.columns else F.lit("*")
        cells = {m: F.col(m).cast(kind) for m in metrics}
        named = part.withColumn("column_name", column)
        return long_format(named, cells, ["column_name"], "metric", "text" if kind == "string" else "value")

    whole = profile_duplicates(df).withColumn("columns", F.lit(len(df.columns)))
    columns = profile_columns(df)
    parts = [
        figures(whole, "rows", "columns", "duplicate_rows", "duplicate_percent"),
        figures(columns, "null_count", "null_percent", "distinct_count", "distinct_percent"),
        figures(
            profile_numeric(df),
            "min", "max", "mean", "median", "negative_values", "zero_values",
        ),
        figures(_column_types(df), "dtype", kind="string"),
        figures(profile_dates(df), "min_date", "max_date", kind="string"),
    ]
    return union_files(parts).select(
        F.lit(dataset).alias("dataset"), "column_name", "metric", "value", "text"
    )


def _column_types(df: DataFrame) -> DataFrame:
    """Type of every column, from the schema alone."""
    return df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema], "column_name string, dtype string"
    )


def profile_datasets(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Profiles of several datasets in one frame."""
    # Driver threads only submit the jobs that store the sorted runs; datasets are independent.
    with ThreadPoolExecutor(4) as pool:
        return union_files(pool.map(lambda item: profile_dataset(item[1], item[0]), datasets.items()))
