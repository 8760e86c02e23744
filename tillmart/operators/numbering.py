"""Consecutive numbers and running totals in sorted order, without one big task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_RUN = "__run"


def _ascending(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def running_total(
    df: DataFrame,
    *,
    order_by: Sequence[str],
    weight: Column,
    output: str,
    within: Sequence[str] = (),
    runs: int | None = None,
) -> DataFrame:
    """Running sum of ``weight`` over all rows in order, per ``within`` group.

    The rows are range-partitioned and written once, so every task holds one
    sorted run however large a group is. Each run then adds the total of the
    runs before it; that table has one row per run and group. ``order_by`` must
    identify a row, else equal rows all fall into one run.
    """
    keys = _ascending([*within, *order_by])
    # Without a number, adaptive execution merges neighbouring small ranges.
    ranges = df.repartitionByRange(runs, *keys) if runs else df.repartitionByRange(*keys)
    ranged, _ = materialize(ranges.withColumn(_RUN, F.spark_partition_id()), "runs")
    earlier = Window.partitionBy(*within).orderBy(_RUN).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        ranged.groupBy(*within, _RUN)
        .agg(F.sum(weight).alias("__sum"))
        .select(
            *[F.col(c).alias(f"__{c}") for c in within],
            F.col(_RUN).alias("__of"),
            F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before"),
        )
    )
    inside = (
        Window.partitionBy(*within, _RUN)
        .orderBy(*_ascending(order_by))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    same = F.col(_RUN) == F.col("__of")
    for c in within:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    # One offset row per run and group; how to join them is decided by their size.
    summed = ranged.withColumn("__inside", F.sum(weight).over(inside))
    return summed.join(offsets, same).select(
        *df.columns, (F.col("__inside") + F.col("__before")).alias(output)
    )


def number_in_order(df: DataFrame, *, order_by: Sequence[str], output: str) -> DataFrame:
    """Number rows 1..n in ascending order, nulls last; the number comes first.

    The result is stored. Small and large tables go the same way.
    """
    numbered = running_total(df, order_by=order_by, weight=F.lit(1), output=output)
    key = F.col(output).cast("bigint").alias(output)
    return materialize(numbered.select(key, *df.columns), output)[0]
