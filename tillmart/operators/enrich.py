"""Business attributes for order headers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import orders
from ..functions.text import strip


def parse_sub_order_type(df: DataFrame, column: str) -> DataFrame:
    """Add raw ``brand`` and ``platform``, split at the last separator.

    Parsing and standardising are projections of their own so that each text
    step runs once per row instead of being repeated inside later expressions.
    """
    text = F.col("__text")
    return (
        df.withColumn("__text", strip(F.col(column)))
        .withColumns({"brand": orders.raw_brand(text), "platform": orders.raw_platform(text)})
        .drop("__text")
    )


def enrich_orders(
    df: DataFrame, *, timestamp_column: str, sub_order_type_column: str | None = None
) -> DataFrame:
    """Add brand, platform, calendar, daypart and validation columns.

    Narrow projections only: no shuffle and no Python worker. Without a sub
    order type column brand and platform are NULL.
    """
    # A column that stayed text gives no date instead of stopping the run.
    stamp = F.col(timestamp_column).try_cast("timestamp_ntz")
    if sub_order_type_column is None:
        nothing = F.lit(None).cast("string")
        named = df.withColumns({"brand": nothing, "platform": nothing})
    else:
        named = parse_sub_order_type(df, sub_order_type_column).withColumns(
            {
                "brand": orders.standard_brand(F.col("brand")),
                "platform": orders.standard_platform(F.col("platform")),
            }
        )
    dated = named.withColumns(
        {**orders.calendar(stamp), "daypart": orders.daypart(stamp)}
    )
    return dated.withColumn(
        "business_validation_errors",
        orders.validation_errors(
            F.col("brand"), F.col("platform"), F.col("business_date"), F.col("daypart")
        ),
    )
