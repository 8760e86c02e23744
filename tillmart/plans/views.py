"""The sixteen analytical views over the star schema, as Spark SQL.

Every view is one aggregation over one fact, joined to small dimensions. Sums run over
the decimal reading of the facts, so they are exact whatever the partitioning; figures
leave the views as DOUBLE.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..functions.numbers import EXACT


def _sum(expression: str) -> str:
    return f"SUM(CAST({expression} AS {EXACT}))"


def _total(expression: str, name: str) -> str:
    return f"CAST({_sum(expression)} AS DOUBLE) AS {name}"


def _round(expression: str, name: str) -> str:
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(38,8)), 2) AS DOUBLE) AS {name}"


def _ratio(numerator: str, denominator: str, name: str, scale: str = "") -> str:
    top, bottom = f"CAST({numerator} AS DOUBLE)", f"CAST({denominator} AS DOUBLE)"
    return _round(f"{scale}{top} / NULLIF({bottom}, 0)", name)


def _mean(column: str, name: str) -> str:
    return _ratio(_sum(column), f"COUNT({column})", name)


_INVOICES = "COUNT(DISTINCT invoice_no)"
_AOV = _ratio(_sum("total"), _INVOICES, "average_order_value")
_GROSS = _total("my_amount", "gross_sales")
_DISCOUNT = _total("discount", "discount")
_TAX = _total("total_tax", "tax")
_NET = _total("total", "net_sales")

# Fixed values below. Views that must show every order join nothing; the others join on a key and
# so leave out rows whose key is missing.
_REASON = (
    "CASE WHEN status = 'Success' THEN 'Not Cancelled' "
    "WHEN order_cancel_reason IS NULL THEN 'Unknown' ELSE order_cancel_reason END"
)


def _select(group: list[str], measures: list[str], source: str, order: str) -> str:
    positions = ", ".join(str(i + 1) for i in range(len(group)))
    columns = ", ".join(group + measures)
    return f"SELECT {columns} FROM {source} GROUP BY {positions} ORDER BY {order}"


def _joined(fact: str, *dimensions: str) -> str:
    joins = "".join(f" JOIN {{dim_{d}}} USING ({d}_key)" for d in dimensions)
    return f"{{fact_{fact}}}{joins}"


def _channel(group: str, source: str) -> str:
    measures = [
        f"{_INVOICES} AS orders", _GROSS, _DISCOUNT, _TAX, _NET, _AOV,
        _mean("discount", "average_discount"),
    ]
    return _select([group], measures, source, ORDER["vw_platform_performance"])


# How each view is ordered; sinks order again by the same terms.
ORDER = {
    "vw_daily_sales": "business_date NULLS LAST, restaurant_name NULLS LAST",
    "vw_platform_performance": "net_sales DESC NULLS LAST",
    "vw_brand_performance": "net_sales DESC NULLS LAST",
    "vw_category_performance": "net_sales DESC NULLS LAST",
    "vw_item_performance": "gross_sales DESC NULLS LAST",
    "vw_kitchen_performance": "average_preparation_time DESC NULLS LAST",
    "vw_daypart_sales": "net_sales DESC NULLS LAST",
    "vw_order_type_performance": "net_sales DESC NULLS LAST",
    "vw_order_status_analysis": "orders DESC NULLS LAST",
    "vw_aov_analysis": "year NULLS LAST, month NULLS LAST",
    "vw_brand_sales": "gross_sales DESC NULLS LAST",
    "vw_platform_sales": "gross_sales DESC NULLS LAST",
    "vw_category_sales": "revenue DESC NULLS LAST",
    "vw_item_sales": "revenue DESC NULLS LAST",
    "vw_discount_analysis": "business_date NULLS LAST",
    "vw_charge_analysis": "business_date NULLS LAST",
}

VIEWS = {
    "vw_daily_sales": _select(
        ["business_date", "weekday", "month", "month_name", "year", "restaurant_name"],
        [
            f"{_INVOICES} AS orders", _GROSS, _DISCOUNT,
            _total("delivery_charge", "delivery_charge"),
            _total("container_charge", "container_charge"), _TAX, _NET, _AOV,
        ],
        _joined("orders", "date", "restaurant"),
        ORDER["vw_daily_sales"],
    ),
    "vw_platform_performance": _channel("platform", _joined("orders", "platform")),
    "vw_brand_performance": _channel("brand", _joined("orders", "brand")),
    "vw_category_performance": _select(
        ["category_name AS category"],
        [
            _total("item_quantity", "items_sold"),
            _total("item_price * item_quantity", "gross_sales"),
            _total("item_total", "net_sales"),
            _ratio(_sum("item_total"), _sum("item_quantity"), "average_item_price"),
        ],
        _joined("order_items", "category"),
        ORDER["vw_category_performance"],
    ),
    "vw_item_performance": _select(
        ["item_name AS item", "category_name AS category"],
        [
            _total("item_quantity", "quantity"),
            _total("item_price * item_quantity", "gross_sales"),
            _mean("item_price", "average_item_price"),
        ],
        _joined("order_items", "item", "category"),
        ORDER["vw_item_performance"],
    ),
    "vw_kitchen_performance": _select(
        ["order_type", "server_name", "item_status"],
        [
            "COUNT(DISTINCT kot_id) AS kitchen_tickets",
            _mean("preparation_time_taken_mins", "average_preparation_time"),
            "CAST(MIN(preparation_time_taken_mins) AS DOUBLE) AS minimum_preparation_time",
            "CAST(MAX(preparation_time_taken_mins) AS DOUBLE) AS maximum_preparation_time",
            # The rating looks at the average before it is rounded.
            f"CASE WHEN {_sum('preparation_time_taken_mins')} < 10 * COUNT(preparation_time_taken_mins)"
            " THEN 'Excellent'"
            f" WHEN {_sum('preparation_time_taken_mins')} < 15 * COUNT(preparation_time_taken_mins)"
            " THEN 'Good' ELSE 'Needs Attention' END AS performance_status",
        ],
        _joined("kitchen"),
        ORDER["vw_kitchen_performance"],
    ),
    "vw_daypart_sales": _channel("COALESCE(daypart, 'Unknown') AS daypart", _joined("orders")),
    "vw_order_type_performance": _channel("order_type", _joined("orders")),
    # The share is taken of a one-row total, not of a window over all groups. The
    # total's condition always holds; it keeps both uses of the groups alike, so
    # that Spark runs the aggregation once and reuses its shuffle.
    "vw_order_status_analysis": (
        "WITH grouped AS ("
        f"SELECT status, {_REASON} AS order_cancel_reason, {_INVOICES} AS orders, "
        f"{_GROSS}, {_NET}, {_AOV} FROM {_joined('orders')} GROUP BY 1, 2) "
        "SELECT *, "
        + _ratio(
            "orders",
            "(SELECT SUM(orders) FROM grouped HAVING COUNT(gross_sales) + COUNT(net_sales) >= 0)",
            "order_percentage",
            "100 * ",
        )
        + f" FROM grouped ORDER BY {ORDER['vw_order_status_analysis']}"
    ),
    "vw_aov_analysis": _select(
        ["year", "month", "month_name"],
        [f"{_INVOICES} AS orders", _total("total", "sales"), _AOV],
        _joined("orders", "date"),
        ORDER["vw_aov_analysis"],
    ),
    "vw_brand_sales": _select(
        ["brand"],
        [f"{_INVOICES} AS total_orders", _GROSS, _DISCOUNT, _NET, _AOV],
        _joined("orders", "brand"),
        ORDER["vw_brand_sales"],
    ),
    "vw_platform_sales": _select(
        ["platform"],
        [f"{_INVOICES} AS total_orders", _GROSS, _DISCOUNT, _TAX, _NET, _AOV],
        _joined("orders", "platform"),
        ORDER["vw_platform_sales"],
    ),
    "vw_category_sales": _select(
        ["category_name"],
        [
            _total("item_quantity", "quantity_sold"),
            _total("item_total", "revenue"),
            _ratio(_sum("item_total"), _sum("item_quantity"), "average_item_price"),
        ],
        _joined("order_items", "category"),
        ORDER["vw_category_sales"],
    ),
    "vw_item_sales": _select(
        ["item_name"],
        [
            _total("item_quantity", "quantity_sold"),
            _total("item_total", "revenue"),
            _mean("item_price", "average_price"),
            f"{_INVOICES} AS number_of_orders",
        ],
        _joined("order_items", "item"),
        ORDER["vw_item_sales"],
    ),
    "vw_discount_analysis": _select(
        ["business_date"],
        [
            _GROSS, _DISCOUNT,
            _ratio(_sum("discount"), _sum("my_amount"), "discount_percentage", "100 * "),
        ],
        _joined("orders", "date"),
        ORDER["vw_discount_analysis"],
    ),
    "vw_charge_analysis": _select(
        ["business_date"],
        [
            *[
                _total(f"{kind}_charge", f"{kind}_charge")
                for kind in ("delivery", "container", "service", "additional", "deduction")
            ],
            _total("total", "total_sales"),
        ],
        _joined("orders", "date"),
        ORDER["vw_charge_analysis"],
    ),
}


def view(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """One view as a DataFrame over the given tables."""
    spark = next(iter(tables.values())).sparkSession
    return spark.sql(VIEWS[name], **tables)


def create_views(spark: SparkSession, tables: Mapping[str, DataFrame], prefix: str = "") -> int:
    """Register the tables and (re)create every view over them; safe to repeat.

    ``prefix`` keeps several warehouses apart in one session.
    """
    stored = {name: prefix + name for name in tables}
    for name, df in tables.items():
        df.createOrReplaceTempView(stored[name])
    for name, body in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {prefix}{name} AS {body.format(**stored)}")
    return len(VIEWS)
