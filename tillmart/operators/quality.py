"""Advisory checks on a typed report: one row per finding."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StructType, TimestampNTZType, TimestampType

from .cleanse import data_columns

# Names and endings that mark an identifier column.
ID_NAMES = ("id", "invoice_no", "bill_no", "kot_no", "order_no")
ID_ENDINGS = ("_id", "_no")

# Earliest date taken seriously, and the finding texts.
EARLIEST = "1900-01-01"
NEGATIVE = "Column '%s' contains %d negative value(s)."
DUPLICATE = "Column '%s' has %d duplicate identifier candidate value(s)."
MISSING = "Column '%s' has %d null identifier value(s)."
IMPOSSIBLE = (
    "Column '%s' contains %d impossible date value(s) (before 1900-01-01 or in the future)."
)


def id_columns(df: DataFrame) -> list[str]:
    """Columns that look like identifiers."""
    names = [(c, c.strip().lower()) for c in data_columns(df)]
    return [c for c, name in names if name in ID_NAMES or name.endswith(ID_ENDINGS)]


def numeric_columns(schema: StructType) -> list[str]:
    """Numbers; booleans do not count."""
    return [
        f.name
        for f in schema
        if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, BooleanType)
    ]


def datetime_columns(schema: StructType) -> list[str]:
    """Timestamps with or without zone."""
    return [f.name for f in schema if isinstance(f.dataType, (TimestampType, TimestampNTZType))]


def long_format(
    df: DataFrame, values: dict[str, Column], by: Sequence[str], name: str, value: str
) -> DataFrame:
    """One row per input row and named value."""
    if not values:
        kind = "struct<n:string,v:string>"
        cells = F.array().cast(f"array<{kind}>")
    else:
        cells = F.array(
            *[F.struct(F.lit(n).alias("n"), v.alias("v")) for n, v in values.items()]
        )
    exploded = df.select(*by, F.explode(cells).alias("cell"))
    return exploded.select(*by, F.col("cell.n").alias(name), F.col("cell.v").alias(value))


def _findings(counts: DataFrame, by: Sequence[str], rule: str, text: str) -> DataFrame:
    name, n = F.col("column_name"), F.col("n").cast("bigint")
    return counts.filter(n > 0).select(
        *by, F.lit(rule).alias("rule"), name, n.alias("n"),
        F.format_string(text, name, n).alias("message"),
    )


def _count_if(
    df: DataFrame, tests: dict[str, Column], by: Sequence[str], rule: str, text: str
) -> DataFrame:
    # One pass counts all columns; only then are the counts turned into rows.
    labels = {f"c{i}": name for i, name in enumerate(tests)}
    counts = [F.count_if(test).alias(f"c{i}") for i, test in enumerate(tests.values())]
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *counts)
    values = {name: F.col(c) for c, name in labels.items()}
    return _findings(long_format(wide, values, by, "column_name", "n"), by, rule, text)


def negative_values(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Numbers below zero, per numeric column."""
    tests = {c: F.col(c) < 0 for c in numeric_columns(df.schema) if c not in by}
    return _count_if(df, tests, by, "negative_values", NEGATIVE)


def null_ids(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Missing values, per identifier column."""
    tests = {c: F.col(c).isNull() for c in id_columns(df)}
    return _count_if(df, tests, by, "null_ids", MISSING)


def impossible_dates(
    df: DataFrame, by: Sequence[str] = (), as_of: Column | None = None
) -> DataFrame:
    """Timestamps before 1900 or after ``as_of`` (now by default)."""
    latest = F.current_timestamp() if as_of is None else as_of
    latest, earliest = (c.cast("timestamp_ntz") for c in (latest, F.lit(EARLIEST)))
    tests = {
        c: (F.col(c) < earliest) | (F.col(c) > latest) for c in datetime_columns(df.schema)
    }
    return _count_if(df, tests, by, "impossible_dates", IMPOSSIBLE)


def duplicate_ids(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows that share a non-null identifier, per identifier column, all copies counted.

    Counts per value are combined before the shuffle, so one very frequent
    identifier costs one row per task.
    """
    ids = {c: F.col(c).cast("string") for c in id_columns(df)}
    values = long_format(df, ids, by, "column_name", "value").filter("value IS NOT NULL")
    copies = values.groupBy(*by, "column_name", "value").agg(F.count(F.lit(1)).alias("copies"))
    shared = copies.filter("copies > 1").groupBy(*by, "column_name")
    return _findings(shared.agg(F.sum("copies").alias("n")), by, "duplicate_ids", DUPLICATE)


def quality_report(
    df: DataFrame, by: Sequence[str] = (), as_of: Column | None = None
) -> DataFrame:
    """All findings. Run before duplicates are removed; nothing is changed."""
    parts = (
        negative_values(df, by),
        duplicate_ids(df, by),
        null_ids(df, by),
        impossible_dates(df, by, as_of),
    )
    return reduce(DataFrame.unionByName, parts)
