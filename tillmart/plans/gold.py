"""The star schema: six dimensions, three facts."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import LOOKUPS, attach_dimension_keys, attach_order_context
from ..operators.numbering import number_in_order
from ..session import materialize

CALENDAR = ("business_date", "weekday", "month", "month_name", "quarter", "year")

# Fixed values. Dimension -> (source dataset, attributes). The first attribute is the business key.
DIMENSIONS = {
    "date": ("orders", CALENDAR),
    "restaurant": ("orders", ("restaurant_name",)),
    "brand": ("orders", ("brand",)),
    "platform": ("orders", ("platform",)),
    "category": ("order_items", ("category_name",)),
    "item": ("order_items", ("item_name",)),
}

ORDER_MEASURES = (
    "my_amount", "total_tax", "discount", "delivery_charge", "container_charge",
    "service_charge", "additional_charge", "deduction_charge", "waived_off",
    "round_off", "total",
)

# Fixed values. Fact -> column -> type, in order. These are the only declared schemas.
FACTS = {
    "orders": {
        "date_key": "bigint", "restaurant_key": "bigint", "brand_key": "bigint",
        "platform_key": "bigint", "invoice_no": "string", "kot_no": "string",
        "daypart": "string", "order_type": "string", "status": "string",
        "order_cancel_reason": "string", **dict.fromkeys(ORDER_MEASURES, "double"),
    },
    "order_items": {
        "date_key": "bigint", "restaurant_key": "bigint", "brand_key": "bigint",
        "platform_key": "bigint", "category_key": "bigint", "item_key": "bigint",
        "invoice_no": "string", "item_quantity": "double", "item_price": "double",
        "item_total": "double",
    },
    "kitchen": {
        "date_key": "bigint", "item_key": "bigint", "kot_id": "bigint",
        "order_type": "string", "server_name": "string", "item_status": "string",
        "qty": "double", "price": "double", "preparation_time_taken_mins": "double",
    },
}


@dataclass(frozen=True)
class GoldLayer:
    """Dimensions and facts by name."""

    dimensions: dict[str, DataFrame]
    facts: dict[str, DataFrame]

    def tables(self) -> dict[str, DataFrame]:
        """All nine tables under their stored names."""
        named = {f"dim_{name}": df for name, df in self.dimensions.items()}
        return named | {f"fact_{name}": df for name, df in self.facts.items()}


def project(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Exactly these columns, in order and in these types; missing ones fail.

    A value that does not fit its type becomes NULL; Silver reports it as a finding.
    """
    missing = [c for c in schema if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(c).try_cast(t).alias(c) for c, t in schema.items()])


def build_dimension(source: DataFrame, name: str) -> DataFrame:
    """Distinct members in sorted order with a 1..n key in front.

    Rows without a business key are dropped, except in the calendar, which
    keeps one row for orders without a date.
    """
    _, attributes = DIMENSIONS[name]
    members = source.select(*attributes)
    if name != "date":
        members = members.na.drop(subset=[attributes[0]])
    key = LOOKUPS[name][1]
    return number_in_order(members.distinct(), order_by=attributes, output=key)


def build_dimensions(orders: DataFrame, order_items: DataFrame) -> dict[str, DataFrame]:
    """All six dimensions, reading each source once.

    The distinct combinations of all attributes are stored first, so four
    dimensions share one scan of the headers and two share one of the lines.
    """
    sources = {"orders": orders, "order_items": order_items}

    def store(source: str) -> DataFrame:
        wanted = [c for s, columns in DIMENSIONS.values() if s == source for c in columns]
        return materialize(sources[source].select(*wanted).distinct(), f"members-{source}")[0]

    def build(name: str) -> DataFrame:
        return build_dimension(members[DIMENSIONS[name][0]], name)

    # Driver threads only submit the jobs side by side.
    with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
        members = dict(zip(sources, pool.map(store, sources)))
        return dict(zip(DIMENSIONS, pool.map(build, DIMENSIONS)))


def build_orders_fact(orders: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Order header grain."""
    return project(attach_dimension_keys(orders, dimensions), FACTS["orders"])


def build_order_items_fact(
    order_items: DataFrame, orders: DataFrame, dimensions: Mapping[str, DataFrame]
) -> DataFrame:
    """Order line grain, dated and branded by its header."""
    in_context = attach_order_context(order_items, orders)
    return project(attach_dimension_keys(in_context, dimensions), FACTS["order_items"])


def build_kitchen_fact(tickets: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Kitchen ticket item grain; dated by its punch time."""
    dated = tickets.withColumn("business_date", F.col("punch_time").try_cast("timestamp_ntz").cast("date"))
    return project(attach_dimension_keys(dated, dimensions), FACTS["kitchen"])


def build_gold_layer(orders: DataFrame, order_items: DataFrame, tickets: DataFrame) -> GoldLayer:
    """Dimensions once, then the facts that share them; facts stay lazy."""
    dimensions = build_dimensions(orders, order_items)
    facts = {
        "orders": build_orders_fact(orders, dimensions),
        "order_items": build_order_items_fact(order_items, orders, dimensions),
        "kitchen": build_kitchen_fact(tickets, dimensions),
    }
    return GoldLayer(dimensions, facts)
