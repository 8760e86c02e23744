"""Queries over order attributes, lookups, the star schema and its views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import orders as o
from ..functions.numbers import mean, safe_ratio, total
from ..operators.cleanse import union_files
from ..operators.enrich import parse_sub_order_type
from ..operators.lookup import (
    LOOKUPS, attach_dimension_keys, attach_order_context, lookup_key,
)
from ..operators.numbering import number_in_order
from ..operators.reconcile import seeded_sample
from ..plans.gold import DIMENSIONS, build_dimension, build_kitchen_fact
from ..plans.views import VIEWS, view
from . import fixtures as fx
from .base import query, r, ratio

# --- order attributes -------------------------------------------------------


@query(
    "parse_sub_order_type",
    "SELECT kot_no, sub_order_type, raw_brand AS brand, raw_platform AS platform FROM parsed",
)
def _parse(spark, sf_dir):
    parsed = parse_sub_order_type(fx.headers(spark, sf_dir), "sub_order_type")
    return parsed.select("kot_no", "sub_order_type", "brand", "platform")


@query("standardize_brand", "SELECT kot_no, brand FROM named")
def _brand(spark, sf_dir):
    parsed = parse_sub_order_type(fx.headers(spark, sf_dir), "sub_order_type")
    return parsed.select("kot_no", o.standard_brand(F.col("brand")).alias("brand"))


@query("standardize_platform", "SELECT kot_no, platform FROM named")
def _platform(spark, sf_dir):
    parsed = parse_sub_order_type(fx.headers(spark, sf_dir), "sub_order_type")
    return parsed.select("kot_no", o.standard_platform(F.col("platform")).alias("platform"))


@query(
    "calendar_attributes",
    "SELECT kot_no, business_date, weekday, month, month_name, quarter, year FROM dated",
)
def _calendar(spark, sf_dir):
    parts = o.calendar(F.col("date"))
    return fx.headers(spark, sf_dir).select("kot_no", *[c.alias(n) for n, c in parts.items()])


@query("daypart", "SELECT kot_no, date, daypart FROM dated")
def _daypart(spark, sf_dir):
    return fx.headers(spark, sf_dir).select(
        "kot_no", "date", o.daypart(F.col("date")).alias("daypart")
    )


@query("business_validation", "SELECT kot_no, business_validation_errors AS errors FROM enriched")
def _validation(spark, sf_dir):
    return fx.enriched(spark, sf_dir).select(
        "kot_no", F.col("business_validation_errors").alias("errors")
    )


@query(
    "enrich_orders",
    "SELECT kot_no, restaurant_name, date, CAST(total AS DOUBLE) AS total, brand, platform,"
    " business_date, weekday, month, month_name, quarter, year, daypart,"
    " business_validation_errors FROM enriched",
)
def _enrich(spark, sf_dir):
    return fx.enriched(spark, sf_dir).select(
        "kot_no", "restaurant_name", "date", "total", "brand", "platform", "business_date",
        "weekday", "month", "month_name", "quarter", "year", "daypart",
        "business_validation_errors",
    )


@query(
    "kitchen_business_date",
    "SELECT CAST(punch_time AS DATE) AS business_date, count(*) AS tickets FROM tickets GROUP BY 1",
)
def _kitchen_date(spark, sf_dir):
    dated = fx.tickets(spark, sf_dir).select(F.to_date("punch_time").alias("business_date"))
    return dated.groupBy("business_date").agg(F.count(F.lit(1)).alias("tickets"))


@query(
    "key_to_string",
    "SELECT CAST(l.l_orderkey AS VARCHAR) AS order_no, count(*) AS lines FROM lineitem l"
    " JOIN orders o ON CAST(l.l_orderkey AS VARCHAR) = CAST(o.o_orderkey AS VARCHAR) GROUP BY 1",
)
def _key_text(spark, sf_dir):
    left = fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_no")
    )
    right = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_no")
    )
    # Lines shrink to one row per key before the join.
    counted = left.groupBy("order_no").agg(F.count(F.lit(1)).alias("lines"))
    # Neither side is ever broadcast: bytes in columns say little about keys as text.
    return counted.join(right.hint("merge"), "order_no")


@query(
    "safe_ratio",
    f"SELECT kot_no, {ratio('total', 'discount')} AS ratio FROM headers",
)
def _safe_ratio(spark, sf_dir):
    ratio_ = safe_ratio(F.col("total"), F.col("discount"))
    return fx.headers(spark, sf_dir).select("kot_no", ratio_.alias("ratio"))


@query(
    "coalesce_label",
    "SELECT COALESCE(daypart, 'Unknown') AS daypart, count(*) AS orders FROM dated GROUP BY 1",
)
def _label(spark, sf_dir):
    label = F.coalesce("daypart", F.lit("Unknown")).alias("daypart")
    return fx.enriched(spark, sf_dir).groupBy(label).agg(F.count(F.lit(1)).alias("orders"))


_REASON_SQL = (
    "CASE WHEN status = 'Success' THEN 'Not Cancelled'"
    " WHEN order_cancel_reason IS NULL THEN 'Unknown' ELSE order_cancel_reason END"
)


@query("case_cancel_reason", f"SELECT kot_no, {_REASON_SQL} AS reason FROM headers")
def _reason(spark, sf_dir):
    reason = o.cancel_reason(F.col("status"), F.col("order_cancel_reason"))
    return fx.headers(spark, sf_dir).select("kot_no", reason.alias("reason"))


@query(
    "case_performance",
    "SELECT server_name, order_type, CASE WHEN avg_time < 10 THEN 'Excellent'"
    " WHEN avg_time < 15 THEN 'Good' ELSE 'Needs Attention' END AS rating FROM"
    " (SELECT server_name, order_type,"
    " CAST(SUM(preparation_time_taken_mins) AS DOUBLE) / COUNT(preparation_time_taken_mins)"
    " AS avg_time FROM tickets GROUP BY ALL) AS t",
)
def _performance(spark, sf_dir):
    minutes = F.col("preparation_time_taken_mins")
    average = F.sum(minutes).cast("double") / F.nullif(F.count(minutes), F.lit(0))
    return (
        fx.tickets(spark, sf_dir)
        .groupBy("server_name", "order_type")
        .agg(o.performance(average).alias("rating"))
    )


# --- lookups ----------------------------------------------------------------


@query(
    "lookup_key",
    "SELECT l.item_name, item_key, count(*) AS lines FROM lines l"
    " LEFT JOIN dim_item i ON i.item_name = l.item_name GROUP BY ALL",
)
def _lookup(spark, sf_dir):
    dim = fx.gold(spark, sf_dir).dimensions["item"]
    keyed = lookup_key(fx.lines(spark, sf_dir), dim, "item_name", "item_key")
    return keyed.groupBy("item_name", "item_key").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "attach_dimension_keys",
    "SELECT kot_no, date_key, restaurant_key, brand_key, platform_key FROM keyed_orders",
)
def _attach(spark, sf_dir):
    dims = fx.gold(spark, sf_dir).dimensions
    keyed = attach_dimension_keys(fx.enriched(spark, sf_dir), dims)
    return keyed.select("kot_no", "date_key", "restaurant_key", "brand_key", "platform_key")


def _register_lookup(name: str, source: str) -> None:
    business, key = LOOKUPS[name]
    keyed_cte = "keyed_orders" if source == "enriched" else "keyed_lines"
    if source == "lines":
        sql = (
            f"SELECT l.{business}, {key}, count(*) AS rows FROM lines l LEFT JOIN dim_{name} d"
            f" ON d.{business} = l.{business} GROUP BY ALL"
        )
    else:
        sql = f"SELECT {business}, {key}, count(*) AS rows FROM {keyed_cte} GROUP BY ALL"

    @query(f"lookup_{name}", sql)
    def _run(spark, sf_dir):
        df = getattr(fx, source)(spark, sf_dir)
        dims = {name: fx.gold(spark, sf_dir).dimensions[name]}
        keyed = attach_dimension_keys(df.select(business), dims)
        return keyed.groupBy(business, key).agg(F.count(F.lit(1)).alias("rows"))


for _name in ("date", "restaurant", "brand", "platform"):
    _register_lookup(_name, "enriched")
for _name in ("category", "item"):
    _register_lookup(_name, "lines")


@query(
    "order_context_join",
    "SELECT restaurant_name, invoice_no, business_date, brand, platform, count(*) AS lines,"
    " CAST(SUM(item_total) AS DOUBLE) AS item_total FROM lines_in_context GROUP BY ALL",
)
def _context(spark, sf_dir):
    joined = attach_order_context(fx.lines(spark, sf_dir), fx.enriched(spark, sf_dir))
    keys = ["restaurant_name", "invoice_no", "business_date", "brand", "platform"]
    return joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("lines"), total(F.col("item_total")).alias("item_total")
    )


@query(
    "star_inner_join",
    "SELECT brand, platform, count(*) AS orders FROM fact_orders"
    " JOIN dim_brand USING (brand_key) JOIN dim_platform USING (platform_key) GROUP BY ALL",
)
def _star(spark, sf_dir):
    gold = fx.gold(spark, sf_dir)
    joined = (
        gold.facts["orders"]
        .join(gold.dimensions["brand"], "brand_key")
        .join(gold.dimensions["platform"], "platform_key")
    )
    return joined.groupBy("brand", "platform").agg(F.count(F.lit(1)).alias("orders"))


# --- aggregation, window, sort ----------------------------------------------


@query(
    "agg_count_distinct",
    "SELECT order_type, count(DISTINCT invoice_no) AS orders FROM headers GROUP BY 1",
)
def _distinct_count(spark, sf_dir):
    grouped = fx.headers(spark, sf_dir).groupBy("order_type")
    return grouped.agg(F.count_distinct("invoice_no").alias("orders"))


@query(
    "agg_sum",
    "SELECT category_name, CAST(SUM(item_total) AS DOUBLE) AS net_sales,"
    " CAST(SUM(item_price * CAST(item_quantity AS DECIMAL(18,3))) AS DOUBLE) AS gross_sales"
    " FROM fact_order_items JOIN dim_category USING (category_key) GROUP BY 1",
)
def _sum(spark, sf_dir):
    gold = fx.gold(spark, sf_dir)
    joined = gold.facts["order_items"].join(gold.dimensions["category"], "category_key")
    return joined.groupBy("category_name").agg(
        total(F.col("item_total")).alias("net_sales"),
        total(F.col("item_price") * F.col("item_quantity")).alias("gross_sales"),
    )


@query(
    "agg_avg",
    f"SELECT status, {ratio('SUM(discount)', 'COUNT(discount)')} AS average_discount"
    " FROM fact_orders GROUP BY 1",
)
def _avg(spark, sf_dir):
    grouped = fx.gold(spark, sf_dir).facts["orders"].groupBy("status")
    return grouped.agg(mean(F.col("discount")).alias("average_discount"))


@query(
    "agg_min_max",
    "SELECT server_name, CAST(min(preparation_time_taken_mins) AS DOUBLE) AS fastest,"
    " CAST(max(preparation_time_taken_mins) AS DOUBLE) AS slowest FROM fact_kitchen GROUP BY 1",
)
def _min_max(spark, sf_dir):
    minutes = "preparation_time_taken_mins"
    grouped = fx.gold(spark, sf_dir).facts["kitchen"].groupBy("server_name")
    return grouped.agg(F.min(minutes).alias("fastest"), F.max(minutes).alias("slowest"))


@query(
    "agg_ratio",
    f"SELECT order_type, {ratio('SUM(total)', 'COUNT(DISTINCT invoice_no)')} AS aov,"
    f" {ratio('SUM(discount)', 'SUM(my_amount)', 4)} AS discount_share"
    " FROM fact_orders GROUP BY 1",
)
def _ratio(spark, sf_dir):
    grouped = fx.gold(spark, sf_dir).facts["orders"].groupBy("order_type")
    return grouped.agg(
        safe_ratio(F.sum("total"), F.count_distinct("invoice_no")).alias("aov"),
        safe_ratio(F.sum("discount"), F.sum("my_amount"), 4).alias("discount_share"),
    )


@query(
    "group_by_expr",
    f"SELECT {_REASON_SQL} AS reason, COALESCE(daypart, 'Unknown') AS daypart,"
    " count(*) AS orders FROM fact_orders GROUP BY 1, 2",
)
def _by_expression(spark, sf_dir):
    reason = o.cancel_reason(F.col("status"), F.col("order_cancel_reason"))
    grouped = fx.gold(spark, sf_dir).facts["orders"].groupBy(
        reason.alias("reason"), F.coalesce("daypart", F.lit("Unknown")).alias("daypart")
    )
    return grouped.agg(F.count(F.lit(1)).alias("orders"))


@query(
    "group_multi_key",
    "SELECT order_type, server_name, item_status, count(*) AS items,"
    " count(DISTINCT kot_id) AS tickets FROM fact_kitchen GROUP BY 1, 2, 3",
)
def _by_several(spark, sf_dir):
    grouped = fx.gold(spark, sf_dir).facts["kitchen"].groupBy(
        "order_type", "server_name", "item_status"
    )
    return grouped.agg(
        F.count(F.lit(1)).alias("items"), F.count_distinct("kot_id").alias("tickets")
    )


@query(
    "window_share_of_total",
    "SELECT platform, orders, " + r("100.0 * orders / SUM(orders) OVER ()") + " AS share FROM"
    " (SELECT platform, count(DISTINCT invoice_no) AS orders FROM enriched GROUP BY 1) AS t",
)
def _share(spark, sf_dir):
    grouped = fx.enriched(spark, sf_dir).groupBy("platform").agg(
        F.count_distinct("invoice_no").alias("orders")
    )
    return spark.sql(
        "SELECT platform, orders, CAST(ROUND(CAST(100 * CAST(orders AS DOUBLE) /"
        " (SELECT SUM(orders) FROM {grouped}) AS DECIMAL(38,8)), 2) AS DOUBLE) AS share"
        " FROM {grouped}",
        grouped=grouped,
    )


@query(
    "surrogate_key",
    "SELECT row_number() OVER (ORDER BY c_name) AS customer_key, c_name"
    " FROM (SELECT DISTINCT c_name FROM customer) AS t",
)
def _numbered(spark, sf_dir):
    names = fx.table(spark, sf_dir, "customer").select("c_name").distinct()
    # Always the range-partitioned way here, whatever the size.
    return number_in_order(names, order_by=["c_name"], output="customer_key")


@query(
    "argmax_first",
    "SELECT l_orderkey, l_extendedprice, l_linenumber FROM (SELECT *, row_number() OVER"
    " (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS place"
    " FROM lineitem) AS t WHERE place = 1",
)
def _argmax(spark, sf_dir):
    best = F.max_by(
        F.struct("l_extendedprice", "l_linenumber"),
        F.struct("l_extendedprice", -F.col("l_linenumber")),
    )
    grouped = fx.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(best.alias("best"))
    return grouped.select("l_orderkey", "best.*")


@query("sort_dim", "SELECT category_key, category_name FROM dim_category ORDER BY category_name")
def _sort_dim(spark, sf_dir):
    dim = build_dimension(fx.lines(spark, sf_dir), "category")
    return dim.orderBy(F.col("category_name").asc_nulls_last())


@query(
    "sort_view",
    "SELECT restaurant_name, CAST(SUM(total) AS DOUBLE) AS net_sales FROM headers"
    " GROUP BY 1 ORDER BY net_sales DESC",
)
def _sort_view(spark, sf_dir):
    grouped = fx.headers(spark, sf_dir).groupBy("restaurant_name")
    return grouped.agg(total(F.col("total")).alias("net_sales")).orderBy(
        F.col("net_sales").desc_nulls_last()
    )


@query(
    "seeded_sample",
    "SELECT kot_no, restaurant_name FROM headers ORDER BY md5('42|' || kot_no), kot_no LIMIT 20",
)
def _sample(spark, sf_dir):
    rows = fx.headers(spark, sf_dir).select("kot_no", "restaurant_name")
    return seeded_sample(rows, 20, 42, ["kot_no"])


# --- star schema ------------------------------------------------------------

for _name in LOOKUPS:

    def _dimension(spark, sf_dir, name=_name):
        source = fx.enriched if DIMENSIONS[name][0] == "orders" else fx.lines
        return build_dimension(source(spark, sf_dir), name)

    query(f"dim_{_name}", f"SELECT * FROM dim_{_name}")(_dimension)

_MONEY = (
    "my_amount", "total_tax", "discount", "delivery_charge", "container_charge",
    "service_charge", "additional_charge", "deduction_charge", "waived_off", "round_off",
    "total",
)


def _doubles(columns) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


@query(
    "fact_orders",
    f"SELECT * REPLACE ({_doubles(_MONEY)}) FROM fact_orders",
)
def _fact_orders(spark, sf_dir):
    return fx.gold(spark, sf_dir).facts["orders"]


@query(
    "fact_order_items",
    f"SELECT * REPLACE ({_doubles(('item_quantity', 'item_price', 'item_total'))})"
    " FROM fact_order_items",
)
def _fact_items(spark, sf_dir):
    return fx.gold(spark, sf_dir).facts["order_items"]


@query(
    "fact_kitchen",
    f"SELECT * REPLACE ({_doubles(('qty', 'price', 'preparation_time_taken_mins'))})"
    " FROM fact_kitchen",
)
def _fact_kitchen(spark, sf_dir):
    return build_kitchen_fact(fx.tickets(spark, sf_dir), fx.gold(spark, sf_dir).dimensions)


_STORED = [f"dim_{n}" for n in LOOKUPS] + ["fact_orders", "fact_order_items", "fact_kitchen"]


@query(
    "gold_layer",
    " UNION ALL ".join(f"SELECT '{t}' AS dataset, count(*) AS rows FROM {t}" for t in _STORED),
)
def _gold_layer(spark, sf_dir):
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dataset"), "rows")
        for name, df in fx.gold(spark, sf_dir).tables().items()
    ]
    return union_files(counts)


# --- analytical views -------------------------------------------------------


def _s(column: str, name: str) -> str:
    return f"CAST(SUM({column}) AS DOUBLE) AS {name}"


_AOV = ratio("SUM(total)", "COUNT(DISTINCT invoice_no)") + " AS average_order_value"
_SALES = ", ".join(
    [
        "COUNT(DISTINCT invoice_no) AS orders", _s("my_amount", "gross_sales"),
        _s("discount", "discount"), _s("total_tax", "tax"), _s("total", "net_sales"), _AOV,
        ratio("SUM(discount)", "COUNT(discount)") + " AS average_discount",
    ]
)
_QUANTITY = "CAST(item_quantity AS DECIMAL(18,3))"
_ITEM_RATIO = ratio("SUM(item_total)", f"SUM({_QUANTITY})") + " AS average_item_price"

VIEW_ORACLES = {
    "vw_daily_sales": "SELECT business_date, weekday, month, month_name, year, restaurant_name,"
    f" COUNT(DISTINCT invoice_no) AS orders, {_s('my_amount', 'gross_sales')},"
    f" {_s('discount', 'discount')}, {_s('delivery_charge', 'delivery_charge')},"
    f" {_s('container_charge', 'container_charge')}, {_s('total_tax', 'tax')},"
    f" {_s('total', 'net_sales')}, {_AOV} FROM fact_orders f"
    " INNER JOIN dim_date d ON d.date_key = f.date_key"
    " INNER JOIN dim_restaurant s ON s.restaurant_key = f.restaurant_key GROUP BY ALL",
    "vw_platform_performance": f"SELECT platform, {_SALES} FROM fact_orders f"
    " INNER JOIN dim_platform p ON p.platform_key = f.platform_key GROUP BY ALL",
    "vw_brand_performance": f"SELECT brand, {_SALES} FROM fact_orders f"
    " INNER JOIN dim_brand b ON b.brand_key = f.brand_key GROUP BY ALL",
    "vw_category_performance": "SELECT category_name AS category,"
    f" {_s(_QUANTITY, 'items_sold')}, {_s(f'item_price * {_QUANTITY}', 'gross_sales')},"
    f" {_s('item_total', 'net_sales')}, {_ITEM_RATIO} FROM fact_order_items f"
    " INNER JOIN dim_category c ON c.category_key = f.category_key GROUP BY ALL",
    "vw_item_performance": "SELECT item_name AS item, category_name AS category,"
    f" {_s(_QUANTITY, 'quantity')}, {_s(f'item_price * {_QUANTITY}', 'gross_sales')},"
    f" {ratio('SUM(item_price)', 'COUNT(item_price)')} AS average_item_price"
    " FROM fact_order_items f INNER JOIN dim_item i ON i.item_key = f.item_key"
    " INNER JOIN dim_category c ON c.category_key = f.category_key GROUP BY ALL",
    "vw_kitchen_performance": "SELECT order_type, server_name, item_status,"
    " COUNT(DISTINCT kot_id) AS kitchen_tickets,"
    f" {ratio('SUM(preparation_time_taken_mins)', 'COUNT(preparation_time_taken_mins)')}"
    " AS average_preparation_time,"
    " CAST(MIN(preparation_time_taken_mins) AS DOUBLE) AS minimum_preparation_time,"
    " CAST(MAX(preparation_time_taken_mins) AS DOUBLE) AS maximum_preparation_time,"
    " CASE WHEN AVG(preparation_time_taken_mins) < 10 THEN 'Excellent'"
    " WHEN AVG(preparation_time_taken_mins) < 15 THEN 'Good'"
    " ELSE 'Needs Attention' END AS performance_status FROM fact_kitchen GROUP BY 1, 2, 3",
    "vw_daypart_sales": f"SELECT COALESCE(daypart, 'Unknown') AS daypart, {_SALES}"
    " FROM fact_orders GROUP BY 1",
    "vw_order_type_performance": f"SELECT order_type, {_SALES} FROM fact_orders GROUP BY 1",
    "vw_order_status_analysis": f"SELECT status, {_REASON_SQL} AS order_cancel_reason,"
    f" COUNT(DISTINCT invoice_no) AS orders, {_s('my_amount', 'gross_sales')},"
    f" {_s('total', 'net_sales')}, {_AOV}, "
    + r("100.0 * COUNT(DISTINCT invoice_no) / SUM(COUNT(DISTINCT invoice_no)) OVER ()")
    + " AS order_percentage FROM fact_orders GROUP BY 1, 2",
    "vw_aov_analysis": "SELECT year, month, month_name, COUNT(DISTINCT invoice_no) AS orders,"
    f" {_s('total', 'sales')}, {_AOV} FROM fact_orders JOIN dim_date USING (date_key)"
    " GROUP BY 1, 2, 3",
    "vw_brand_sales": "SELECT brand, COUNT(DISTINCT invoice_no) AS total_orders,"
    f" {_s('my_amount', 'gross_sales')}, {_s('discount', 'discount')}, {_s('total', 'net_sales')},"
    f" {_AOV} FROM keyed_orders WHERE brand IS NOT NULL GROUP BY 1",
    "vw_platform_sales": "SELECT platform, COUNT(DISTINCT invoice_no) AS total_orders,"
    f" {_s('my_amount', 'gross_sales')}, {_s('discount', 'discount')}, {_s('total_tax', 'tax')},"
    f" {_s('total', 'net_sales')}, {_AOV} FROM keyed_orders WHERE platform IS NOT NULL GROUP BY 1",
    "vw_category_sales": f"SELECT category_name, {_s(_QUANTITY, 'quantity_sold')},"
    f" {_s('item_total', 'revenue')}, {_ITEM_RATIO} FROM keyed_lines"
    " WHERE category_name IS NOT NULL GROUP BY 1",
    "vw_item_sales": f"SELECT item_name, {_s(_QUANTITY, 'quantity_sold')},"
    f" {_s('item_total', 'revenue')}, {ratio('SUM(item_price)', 'COUNT(item_price)')}"
    " AS average_price, COUNT(DISTINCT invoice_no) AS number_of_orders FROM keyed_lines"
    " WHERE item_name IS NOT NULL GROUP BY 1",
    "vw_discount_analysis": f"SELECT business_date, {_s('my_amount', 'gross_sales')},"
    f" {_s('discount', 'discount')}, {ratio('100.0 * SUM(discount)', 'SUM(my_amount)')}"
    " AS discount_percentage FROM keyed_orders GROUP BY 1",
    "vw_charge_analysis": "SELECT business_date, "
    + ", ".join(
        _s(f"{k}_charge", f"{k}_charge")
        for k in ("delivery", "container", "service", "additional", "deduction")
    )
    + f", {_s('total', 'total_sales')} FROM keyed_orders GROUP BY 1",
}

for _name in VIEWS:

    def _view(spark, sf_dir, name=_name):
        return view(fx.gold(spark, sf_dir).tables(), name)

    query(_name, VIEW_ORACLES[_name])(_view)
