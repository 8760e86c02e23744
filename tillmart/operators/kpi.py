"""Headline figures of the three dashboard pages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import safe_ratio, total
from .cleanse import union_files
from .quality import long_format

# Fixed value: minutes from which a kitchen ticket counts as slow.
SLOW_MINUTES = 15


def _filtered(fact: DataFrame, dimension: DataFrame, key: str, keep: Column | None) -> DataFrame:
    return fact if keep is None else fact.join(dimension.filter(keep).select(key), key)


def kpi_cards(
    tables: Mapping[str, DataFrame],
    *,
    dates: Column | None = None,
    brands: Column | None = None,
    platforms: Column | None = None,
) -> DataFrame:
    """Card name and value. Conditions are on the dimension tables' columns.

    A condition filters the dimension first, so only the surviving keys meet
    the fact. The kitchen has no brand or channel, so only dates apply to it.
    """
    sales = _filtered(tables["fact_orders"], tables["dim_date"], "date_key", dates)
    sales = _filtered(sales, tables["dim_brand"], "brand_key", brands)
    sales = _filtered(sales, tables["dim_platform"], "platform_key", platforms)
    orders = F.count_distinct("invoice_no")
    sales_cards = sales.agg(
        total(F.col("total")).alias("Net Sales"),
        total(F.col("my_amount")).alias("Gross Sales"),
        orders.cast("double").alias("Orders"),
        safe_ratio(total(F.col("total")), orders).alias("Average Order Value"),
        safe_ratio(100 * total(F.col("discount")), total(F.col("my_amount"))).alias("Average Discount %"),
        total(F.col("total_tax")).alias("Tax"),
    )
    minutes = F.col("preparation_time_taken_mins")
    # One row per ticket first: distinct tickets, all and slow, without an expand.
    per_ticket = (
        _filtered(tables["fact_kitchen"], tables["dim_date"], "date_key", dates)
        .groupBy("kot_id")
        .agg(
            total(minutes).alias("minutes"),
            F.count(minutes).alias("timed"),
            F.max(minutes >= SLOW_MINUTES).alias("slow"),
        )
    )
    kitchen_cards = per_ticket.agg(
        safe_ratio(total(F.col("minutes")), F.sum("timed")).alias("Average Preparation Time"),
        F.count("kot_id").cast("double").alias("Kitchen Tickets"),
        F.count_if(F.col("slow") & F.col("kot_id").isNotNull()).cast("double").alias(
            "Slow Kitchen Tickets"
        ),
    )
    return union_files(
        long_format(cards, {c: F.col(c) for c in cards.columns}, [], "card", "value")
        for cards in (sales_cards, kitchen_cards)
    )
