"""Surrogate key lookups and the join of order lines to their headers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Dimension name -> (business column, key column), in lookup order.
LOOKUPS = {
    "date": ("business_date", "date_key"),
    "restaurant": ("restaurant_name", "restaurant_key"),
    "brand": ("brand", "brand_key"),
    "platform": ("platform", "platform_key"),
    "category": ("category_name", "category_key"),
    "item": ("item_name", "item_key"),
}

CONTEXT_KEYS = ("restaurant_name", "invoice_no")
CONTEXT_COLUMNS = ("business_date", "brand", "platform")


def lookup_key(
    df: DataFrame,
    dimension: DataFrame,
    business_column: str,
    key_column: str,
    *,
    null_safe: bool = False,
) -> DataFrame:
    """Left join that adds one surrogate key; every row of ``df`` stays.

    No broadcast hint: dimensions are stored tables, so Catalyst broadcasts
    them while their size is below the threshold and otherwise shuffles, with
    adaptive execution splitting hot values.
    """
    if business_column not in df.columns:
        return df
    pairs = dimension.select(F.col(business_column).alias("__business"), key_column)
    left, right = F.col(business_column), F.col("__business")
    same = left.eqNullSafe(right) if null_safe else left == right
    return df.join(pairs, same, "left").drop("__business")


def attach_dimension_keys(df: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Add the key of every dimension given; missing dimensions are skipped."""
    for name, (business_column, key_column) in LOOKUPS.items():
        if name in dimensions:
            # Only the calendar keeps a row for "no value", and it must match.
            df = lookup_key(
                df, dimensions[name], business_column, key_column, null_safe=name == "date"
            )
    return df


# How many candidates for hot keys are looked at, how many the sketch tracks, and how many
# rows a block must give before it is worth splitting.
CANDIDATES, TRACKED, WORTH = 100, 10_000, 1_000_000


def _key(restaurant: str, invoice: str) -> Column:
    """Both parts of a header key as one text that is never NULL."""
    return F.to_json(F.struct(F.col(restaurant).alias("r"), F.col(invoice).alias("i")))


def hot_blocks(lines: DataFrame, context: DataFrame, worth: int = WORTH) -> list[tuple]:
    """(key, rows of lines, rows of headers, splits of lines, splits of headers) of hot keys.

    A key repeated on both sides gives a block of m x n rows, and that block is one task's
    unless it is split. Keys that repeat much are found by a sketch that combines before
    any shuffle; both sides of its few candidates are then counted exactly. Blocks above a
    quarter of a task's mean share are cut into rectangles of that size, with sides in
    proportion, so that the rows sent twice are as few as can be.
    """
    spark = context.sparkSession
    sketch = F.expr(f"approx_top_k(__key, {CANDIDATES}, {TRACKED})")
    found = context.agg(sketch.alias("top"), F.count(F.lit(1)).alias("n")).first()
    repeated = [c["item"] for c in found["top"] if c["count"] > 1]
    if not repeated:
        return []
    named = F.broadcast(spark.createDataFrame([(k,) for k in repeated], "__key string"))
    sides = [
        {r["__key"]: r["count"] for r in side.join(named, "__key").groupBy("__key").count().collect()}
        for side in (lines, context)
    ]
    blocks = {k: (sides[0][k], sides[1][k]) for k in repeated if k in sides[0] and k in sides[1]}
    total = lines.count() + sum(m * n for m, n in blocks.values())
    share = max(worth, total // (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    cut = []
    for key, (m, n) in blocks.items():
        cells = -(-m * n // share)
        if n > 1 and cells > 1:
            a = min(m, max(1, round((cells * m / n) ** 0.5)))
            cut.append((key, m, n, a, min(n, -(-cells // a))))
    return cut


def attach_order_context(lines: DataFrame, headers: DataFrame, worth: int = WORTH) -> DataFrame:
    """Give each order line the date, brand and platform of its header.

    The one join of two large tables. Only five header columns travel, and they are never
    broadcast: stored headers pack so well that their bytes say little; a line
    whose header key repeats is repeated too, and missing keys match each other.
    Hot line keys are split by adaptive skew handling, which the plain left join
    leaves possible because nothing downstream needs its partitioning. Keys that
    repeat among the headers as well are cut into rectangles (``hot_blocks``).
    """
    lines = lines.withColumn("invoice_no", F.col("invoice_no").cast("string"))
    context = headers.select(
        F.col("restaurant_name").alias("__restaurant"),
        F.col("invoice_no").cast("string").alias("__invoice"),
        *CONTEXT_COLUMNS,
    ).hint("merge")
    # Rows are sorted by the parts of the key in this order. Outlets are few, so that
    # almost every comparison is decided by the number if it comes first.
    same = F.col("invoice_no").eqNullSafe(F.col("__invoice")) & F.col(
        "restaurant_name"
    ).eqNullSafe(F.col("__restaurant"))
    keyed = [
        lines.withColumn("__key", _key("restaurant_name", "invoice_no")),
        context.withColumn("__key", _key("__restaurant", "__invoice")),
    ]
    blocks = hot_blocks(*keyed, worth)
    if not blocks:
        return lines.join(context, same, "left").drop("__restaurant", "__invoice")

    # One row per hot key, at most CANDIDATES.
    hot = F.broadcast(
        lines.sparkSession.createDataFrame(
            blocks, "__key string, m long, n long, a int, b int"
        ).withColumn("__block", F.monotonically_increasing_id())
    )
    plain = [side.join(hot, "__key", "left_anti").drop("__key") for side in keyed]
    rest = plain[0].join(plain[1], same, "left").drop("__restaurant", "__invoice")

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        # Each row goes to one strip of its own side and crosses all strips of the other.
        salted = side.join(hot, "__key").withColumn(own, F.floor(F.rand(7) * F.col(own)).cast("int"))
        return salted.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))

    cells = ["__block", "a", "b"]
    left = dealt(keyed[0], "a", "b").select(*lines.columns, *cells)
    right = dealt(keyed[1], "b", "a").select(*CONTEXT_COLUMNS, *cells)
    # Every key here has headers, so no line of it is left alone.
    return rest.unionByName(left.join(right, cells).drop(*cells))
