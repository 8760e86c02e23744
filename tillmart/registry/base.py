"""Registry of queries and their oracle SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DecimalType, FloatType, IntegerType, LongType, TimestampType,
)

from .fixtures import BINDINGS, TABLES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Types both engines share: bigint, double, string, date, timestamp."""
    columns = []
    for f in df.schema:
        c, kind = F.col(f"`{f.name}`"), f.dataType
        if isinstance(kind, (DecimalType, FloatType)):
            c = c.cast("double")
        elif isinstance(kind, IntegerType):
            c = c.cast("bigint")
        elif isinstance(kind, TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(kind, ArrayType):
            c = F.array_join(c, "; ")
        columns.append(c.alias(f.name) if not isinstance(kind, LongType) else c)
    return df.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, if given, the SQL that must return the same rows."""

    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(run(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return run

    return register


def r(expression: str, digits: int = 2) -> str:
    """Rounded double in SQL, half up on the decimal reading."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def ratio(top: str, bottom: str, digits: int = 2) -> str:
    """Rounded ratio in SQL, NULL for a zero divisor."""
    return r(f"CAST({top} AS DOUBLE) / NULLIF(CAST({bottom} AS DOUBLE), 0)", digits)


_CLOCK = "(extract(HOUR FROM date) * 3600 + extract(MINUTE FROM date) * 60 + extract(SECOND FROM date))"
_BLANK = "' ' || chr(9) || chr(10) || chr(13)"

CTES = {
    name: text.format(**{t: t for t in TABLES}) for name, text in BINDINGS.items()
}
CTES["parsed"] = f"""
SELECT *,
  CASE WHEN contains(whole, ' - ')
       THEN nullif(trim(regexp_extract(whole, '^(.*) - (.*)$', 1, 's'), {_BLANK}), '')
  END AS raw_brand,
  nullif(trim(CASE WHEN contains(whole, ' - ')
                   THEN regexp_extract(whole, '^(.*) - (.*)$', 2, 's')
                   ELSE whole END, {_BLANK}), '') AS raw_platform
FROM (SELECT *, trim(sub_order_type, {_BLANK}) AS whole FROM headers) AS stripped
"""
CTES["named"] = r"""
SELECT *,
  CASE trim(regexp_replace(regexp_replace(lower(raw_brand), '\band\b', '&', 'g'), '\s+', ' ', 'g'))
    WHEN 'thepla house' THEN 'Thepla House By Tejals'
    WHEN 'thepla house by tejals' THEN 'Thepla House By Tejals'
    WHEN 'homely healthy' THEN 'Homely & Healthy'
    WHEN 'homely & healthy' THEN 'Homely & Healthy'
    WHEN 'homely & healthy app' THEN 'Homely & Healthy'
    ELSE raw_brand END AS brand,
  CASE lower(raw_platform)
    WHEN 'swiggy' THEN 'Swiggy' WHEN 'swiggy (toing)' THEN 'Swiggy'
    WHEN 'zomato' THEN 'Zomato' WHEN 'delivery' THEN 'Delivery'
    WHEN 'pick up' THEN 'Pick Up' WHEN 'dine in' THEN 'Dine In'
    ELSE raw_platform END AS platform
FROM parsed
"""
CTES["dated"] = f"""
SELECT *,
  CAST(date AS DATE) AS business_date, dayname(date) AS weekday,
  CAST(month(date) AS BIGINT) AS month, monthname(date) AS month_name,
  CAST(quarter(date) AS BIGINT) AS quarter, CAST(year(date) AS BIGINT) AS year,
  CASE WHEN {_CLOCK} BETWEEN 18000 AND 39540 THEN 'Breakfast'
       WHEN {_CLOCK} BETWEEN 39600 AND 57540 THEN 'Lunch'
       WHEN {_CLOCK} BETWEEN 57600 AND 68340 THEN 'Snacks'
       WHEN {_CLOCK} BETWEEN 68400 AND 82740 THEN 'Dinner'
       WHEN {_CLOCK} >= 82800 OR {_CLOCK} <= 17940 THEN 'Late Night' END AS daypart
FROM named
"""
CTES["enriched"] = """
SELECT *, concat_ws('; ',
  CASE WHEN brand NOT IN ('Thepla House By Tejals', 'Homely & Healthy') THEN 'Unknown brand' END,
  CASE WHEN platform NOT IN ('Swiggy', 'Zomato', 'Delivery', 'Pick Up', 'Dine In')
       THEN 'Unknown platform' END,
  CASE WHEN business_date IS NULL THEN 'Missing business date' END,
  CASE WHEN daypart IS NULL THEN 'Missing daypart' END,
  CASE WHEN brand IS NOT NULL AND platform IS NULL THEN 'Brand exists without platform' END,
  CASE WHEN brand IS NULL AND platform NOT IN ('Delivery', 'Pick Up', 'Dine In')
       THEN 'Platform exists without brand' END) AS business_validation_errors
FROM dated
"""


def _dim(name: str, business: str, source: str) -> str:
    return (
        f"SELECT row_number() OVER (ORDER BY {business}) AS {name}_key, {business} FROM "
        f"(SELECT DISTINCT {business} FROM {source} WHERE {business} IS NOT NULL) AS members"
    )


CTES["dim_date"] = """
SELECT row_number() OVER (ORDER BY business_date NULLS LAST) AS date_key, *
FROM (SELECT DISTINCT business_date, weekday, month, month_name, quarter, year FROM enriched) AS m
"""
CTES["dim_restaurant"] = _dim("restaurant", "restaurant_name", "enriched")
CTES["dim_brand"] = _dim("brand", "brand", "enriched")
CTES["dim_platform"] = _dim("platform", "platform", "enriched")
CTES["dim_category"] = _dim("category", "category_name", "lines")
CTES["dim_item"] = _dim("item", "item_name", "lines")
CTES["keyed_orders"] = """
SELECT e.*, date_key, restaurant_key, brand_key, platform_key FROM enriched e
LEFT JOIN dim_date d ON d.business_date IS NOT DISTINCT FROM e.business_date
LEFT JOIN dim_restaurant r ON r.restaurant_name = e.restaurant_name
LEFT JOIN dim_brand b ON b.brand = e.brand
LEFT JOIN dim_platform p ON p.platform = e.platform
"""
CTES["fact_orders"] = """
SELECT date_key, restaurant_key, brand_key, platform_key, invoice_no, kot_no, daypart,
  order_type, status, order_cancel_reason, my_amount, total_tax, discount, delivery_charge,
  container_charge, service_charge, additional_charge, deduction_charge, waived_off,
  round_off, total
FROM keyed_orders
"""
CTES["lines_in_context"] = """
SELECT l.*, e.business_date, e.brand, e.platform FROM lines l
LEFT JOIN enriched e ON e.restaurant_name = l.restaurant_name AND e.invoice_no = l.invoice_no
"""
CTES["keyed_lines"] = """
SELECT l.*, date_key, restaurant_key, brand_key, platform_key, category_key, item_key
FROM lines_in_context l
LEFT JOIN dim_date d ON d.business_date IS NOT DISTINCT FROM l.business_date
LEFT JOIN dim_restaurant r ON r.restaurant_name = l.restaurant_name
LEFT JOIN dim_brand b ON b.brand = l.brand
LEFT JOIN dim_platform p ON p.platform = l.platform
LEFT JOIN dim_category c ON c.category_name = l.category_name
LEFT JOIN dim_item i ON i.item_name = l.item_name
"""
CTES["fact_order_items"] = """
SELECT date_key, restaurant_key, brand_key, platform_key, category_key, item_key, invoice_no,
  item_quantity, item_price, item_total FROM keyed_lines
"""
CTES["keyed_tickets"] = """
SELECT t.*, CAST(t.punch_time AS DATE) AS business_date, date_key, item_key FROM tickets t
LEFT JOIN dim_date d ON d.business_date = CAST(t.punch_time AS DATE)
LEFT JOIN dim_item i ON i.item_name = t.item_name
"""
CTES["fact_kitchen"] = """
SELECT date_key, item_key, kot_id, order_type, server_name, item_status, qty, price,
  preparation_time_taken_mins FROM keyed_tickets
"""


def with_ctes(sql: str) -> str:
    """Put the CTEs a statement needs in front of it, in order of definition."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & CTES.keys() - needed:
            needed.add(name)
            todo.append(CTES[name])
    if not needed:
        return sql.strip()
    parts = ",\n".join(f"{n} AS ({text.strip()})" for n, text in CTES.items() if n in needed)
    return f"WITH {parts}\n{sql.strip()}"
