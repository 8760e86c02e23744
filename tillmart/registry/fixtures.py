"""Shapes the driver's tables as outlet sales data.

Each binding is SQL that Spark and DuckDB read alike. ``{orders}`` and the like
stand for the tables: DataFrames in Spark, view names in DuckDB. A binding is a
plain projection and a join to small tables: no windows, no row subsets.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from ..operators.enrich import enrich_orders
from ..plans.gold import GoldLayer, build_gold_layer
from ..session import materialize, sided

TABLES = ("nation", "part", "orders", "lineitem", "events", "documents")


def _invoice(key: str) -> str:
    # Unique within an outlet except where the last digits are 999, whose
    # number repeats the outlet's previous one; collides across outlets.
    return (
        f"CAST(CAST(floor({key} / 25) AS BIGINT)"
        f" - CASE WHEN {key} % 1000 = 999 THEN 1 ELSE 0 END AS STRING)"
    )


HEADERS = f"""
SELECT
  n.n_name AS restaurant_name,
  {_invoice('o.o_orderkey')} AS invoice_no,
  concat('K', CAST(o.o_orderkey AS STRING)) AS kot_no,
  CASE WHEN o.o_orderkey % 97 = 3 THEN NULL
       ELSE o.o_orderdate + ((o.o_orderkey * 7919) % 86400) * INTERVAL '1' SECOND
  END AS date,
  CASE WHEN o.o_orderkey % 71 = 0 THEN NULL
       WHEN o.o_orderkey % 53 = 0 THEN 'Night  Kitchen - Zomato'
       WHEN o.o_orderkey % 89 = 1 THEN concat('thepla HOUSE by tejals - Swiggy', chr(10), '(Toing)')
       WHEN o.o_orderkey % 83 = 2 THEN 'A - - Zomato'
       WHEN o.o_orderpriority = '1-URGENT' THEN 'Thepla House - Zomato'
       WHEN o.o_orderpriority = '2-HIGH' THEN 'Homely  and Healthy - Swiggy (Toing)'
       WHEN o.o_orderpriority = '3-MEDIUM' THEN 'Dine In'
       WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN '  Pick Up '
       ELSE 'Homely & Healthy App - SWIGGY' END AS sub_order_type,
  CASE o.o_orderpriority WHEN '3-MEDIUM' THEN 'Dine In'
       WHEN '4-NOT SPECIFIED' THEN 'Pick Up' ELSE 'Delivery(Parcel)' END AS order_type,
  CASE WHEN o.o_orderstatus = 'P' THEN 'Cancelled' ELSE 'Success' END AS status,
  CASE WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 3 = 0 THEN 'Customer Cancellation'
       WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 3 = 1 THEN 'Item out of stock'
  END AS order_cancel_reason,
  CAST(o.o_totalprice AS DECIMAL(18,2)) - CAST(o.o_orderkey % 13 AS DECIMAL(18,2)) AS my_amount,
  CAST((o.o_orderkey % 5000) / 100.0 AS DECIMAL(18,2)) AS total_tax,
  CAST((o.o_orderkey % 1100) / 100.0 AS DECIMAL(18,2)) AS discount,
  CAST(o.o_orderkey % 3 * 10 AS DECIMAL(18,2)) AS delivery_charge,
  CAST(o.o_orderkey % 7 * 5 AS DECIMAL(18,2)) AS container_charge,
  o.o_orderkey % 4 AS service_charge,
  o.o_orderkey % 2 AS additional_charge,
  o.o_orderkey % 5 AS deduction_charge,
  CAST(o.o_orderkey % 17 / 10.0 AS DECIMAL(18,2)) AS waived_off,
  CAST((o.o_orderkey % 99 - 49) / 100.0 AS DECIMAL(18,2)) AS round_off,
  CAST(o.o_totalprice AS DECIMAL(18,2)) AS total,
  concat('orders_', CAST(extract(YEAR FROM o.o_orderdate) AS STRING), '.csv') AS source_file
FROM {{orders}} o JOIN {{nation}} n ON n.n_nationkey = o.o_orderkey % 25
"""

LINES = f"""
SELECT
  n.n_name AS restaurant_name,
  CASE WHEN l.l_orderkey % 50 = 7 THEN concat('X', CAST(l.l_orderkey AS STRING))
       ELSE {_invoice('l.l_orderkey')} END AS invoice_no,
  p.p_name AS item_name,
  CASE WHEN l.l_partkey % 83 = 5 THEN NULL ELSE p.p_type END AS category_name,
  l.l_quantity AS item_quantity,
  CAST(floor(l.l_extendedprice * 100 / l.l_quantity) / 100 AS DECIMAL(18,2)) AS item_price,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) AS item_total,
  concat('items_', CAST(extract(YEAR FROM l.l_shipdate) AS STRING), '.csv') AS source_file
FROM {{lineitem}} l
JOIN {{part}} p ON p.p_partkey = l.l_partkey
JOIN {{nation}} n ON n.n_nationkey = l.l_orderkey % 25
"""

TICKETS = """
SELECT
  CAST(floor(e.event_id / 3) AS BIGINT) AS kot_id,
  e.ts - INTERVAL '9131' DAY AS punch_time,
  e.ts - INTERVAL '9131' DAY + e.event_id % 3600 * INTERVAL '1' SECOND AS prepared_time,
  CASE e.event_type WHEN 'view' THEN 'Dine In' WHEN 'click' THEN 'Pick Up'
       ELSE 'Delivery (Parcel)' END AS order_type,
  concat('server_', CAST(e.user_id % 20 AS STRING)) AS server_name,
  CASE WHEN e.event_id % 41 = 11 THEN 'off menu special' ELSE p.p_name END AS item_name,
  CASE WHEN e.event_type = 'error' THEN 'Cancelled' ELSE 'Success' END AS item_status,
  CAST(e.event_id % 4 + 1 AS DOUBLE) AS qty,
  CAST(e.value AS DECIMAL(18,2)) AS price,
  CAST(floor(e.value * 25) / 100 AS DECIMAL(18,2)) AS preparation_time_taken_mins
FROM {events} e LEFT JOIN {part} p ON p.p_partkey = e.user_id
"""

BINDINGS = {"headers": HEADERS, "lines": LINES, "tickets": TICKETS}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Headers, lines or tickets as a lazy DataFrame."""
    text = BINDINGS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in text}
    if "part" in used:
        # Parts are few bytes in a file and many in a join; lines and events are never sent.
        used["part"] = sided(used["part"], [c for c in used["part"].columns if c in text])
    return spark.sql(text, **used)


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers before enrichment."""
    return bound(spark, sf_dir, "headers")


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers with their business attributes."""
    return enrich_orders(
        headers(spark, sf_dir), timestamp_column="date", sub_order_type_column="sub_order_type"
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines."""
    return bound(spark, sf_dir, "lines")


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kitchen ticket items."""
    return bound(spark, sf_dir, "tickets")


@lru_cache(maxsize=8)
def gold(spark: SparkSession, sf_dir: str) -> GoldLayer:
    """The star schema over the whole tables.

    The stored dimensions are shared by all queries of a session; facts are
    lazy. Headers are stored enriched, as Silver holds them: dimensions, the context
    of lines and the facts read them, and text is parsed once instead of three times.
    """
    orders, _ = materialize(
        enriched(spark, sf_dir).drop("business_validation_errors"), "enriched"
    )
    return build_gold_layer(orders, lines(spark, sf_dir), tickets(spark, sf_dir))
