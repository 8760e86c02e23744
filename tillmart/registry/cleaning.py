"""Queries over cleansing, inference, quality, reconciliation and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleanse, infer, profile, quality, reconcile
from ..operators.kpi import kpi_cards
from ..operators.lookup import attach_dimension_keys, attach_order_context
from ..operators.silver import run_metrics, silver_pipeline
from ..plans.gold import DIMENSIONS, FACTS, LOOKUPS, project
from . import fixtures as fx
from .base import query, r, ratio
from .raw import AMOUNTS, COPIES_SQL, raw_headers

# --- cleansing --------------------------------------------------------------

# Raw text of every header row, repeated as exported.
_RAW = (
    f"(SELECT h.*, CAST(range AS BIGINT) AS copy FROM headers h,"
    f" LATERAL range(1, 1 + {COPIES_SQL})) AS raw"
)


@query(
    "standardize_columns",
    "SELECT kot_no, invoice_no, CAST(total_tax AS VARCHAR) AS total_tax,"
    " CAST(additional_charge AS VARCHAR) AS additional_charge, status,"
    f" CAST(total AS VARCHAR) AS total FROM {_RAW}",
)
def _names(spark, sf_dir):
    renamed = cleanse.standardize_columns(raw_headers(spark, sf_dir))
    return renamed.select(
        "kot_no", "invoice_no", "total_tax", "additional_charge", "status", "total"
    )


@query(
    "trim_text",
    "SELECT kot_no, restaurant_name, COALESCE(order_cancel_reason, '--') AS order_cancel_reason,"
    " COALESCE(strftime(date, '%Y-%m-%d %H:%M:%S'), 'N/A') AS date"
    f" FROM {_RAW}",
)
def _trim(spark, sf_dir):
    trimmed = cleanse.trim_text(cleanse.standardize_columns(raw_headers(spark, sf_dir)))
    return trimmed.select("kot_no", "restaurant_name", "order_cancel_reason", "date")


@query(
    "null_tokens",
    "SELECT kot_no, restaurant_name, order_cancel_reason,"
    " strftime(date, '%Y-%m-%d %H:%M:%S') AS date,"
    f" sub_order_type IS NULL AS untyped FROM {_RAW}",
)
def _nulls(spark, sf_dir):
    clean = cleanse.handle_nulls(cleanse.standardize_columns(raw_headers(spark, sf_dir)))
    return clean.select(
        "kot_no", "restaurant_name", "order_cancel_reason", "date",
        F.col("sub_order_type").isNull().alias("untyped"),
    )


@query(
    "project_required",
    "SELECT restaurant_name, business_date, brand, CAST(total AS DOUBLE) AS total FROM enriched",
)
def _project(spark, sf_dir):
    wanted = {
        "restaurant_name": "string", "business_date": "date", "brand": "string",
        "total": "decimal(18,2)",
    }
    return project(fx.enriched(spark, sf_dir), wanted)


def _inferred(df, **candidates):
    return infer.convert_columns(df, infer.infer_types(df, **candidates))


@query(
    "infer_datetime",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate AS iso, l_shipdate AS slashed,"
    " CASE WHEN l_suppkey % 5 = 0 THEN '2020-13-45' ELSE"
    " strftime(l_shipdate, '%Y-%m-%d') END AS mixed FROM lineitem",
)
def _infer_datetime(spark, sf_dir):
    shipped = F.col("l_shipdate")
    text = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.date_format(shipped, "yyyy-MM-dd HH:mm:ss").alias("iso"),
        F.date_format(shipped, "dd/MM/yyyy").alias("slashed"),
        F.when(F.col("l_suppkey") % 5 == 0, "2020-13-45")
        .otherwise(F.date_format(shipped, "yyyy-MM-dd")).alias("mixed"),
    )
    return _inferred(text, candidates=tuple(dict(infer.DATETIME_LAYOUTS)))


@query(
    "infer_numeric",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) AS whole, l_extendedprice AS fraction,"
    " concat('#', CAST(l_partkey AS VARCHAR)) AS label FROM lineitem",
)
def _infer_numeric(spark, sf_dir):
    text = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_quantity").cast("string").alias("whole"),
        F.col("l_extendedprice").cast("string").alias("fraction"),
        F.concat(F.lit("#"), "l_partkey").alias("label"),
    )
    return _inferred(text, candidates=("bigint", "double"))


@query(
    "infer_boolean",
    "SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN true"
    " WHEN 'click' THEN true ELSE false END AS flag,"
    " event_type AS label FROM events",
)
def _infer_boolean(spark, sf_dir):
    kind = F.col("event_type")
    flag = (
        F.when(kind == "view", "Yes").when(kind == "click", "y")
        .when(kind == "signup", "NO").when(kind == "purchase", "false")
    )
    text = fx.table(spark, sf_dir, "events").select(
        "event_id", flag.alias("flag"), kind.alias("label")
    )
    return _inferred(text, candidates=("boolean",))


_TYPED = (
    "kot_no, restaurant_name, CAST(invoice_no AS BIGINT) AS invoice_no, date, status,"
    " order_cancel_reason, service_charge, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in AMOUNTS)
)
_TYPED_COLUMNS = (
    "kot_no", "restaurant_name", "invoice_no", "date", "status", "order_cancel_reason",
    "service_charge", *AMOUNTS,
)


@query("convert_datatypes", f"SELECT {_TYPED} FROM {_RAW}")
def _convert(spark, sf_dir):
    text = cleanse.handle_nulls(cleanse.standardize_columns(raw_headers(spark, sf_dir)))
    return infer.convert_datatypes(text).select(*_TYPED_COLUMNS)


@query(
    "drop_null_keys",
    "SELECT category_name, count(*) AS lines FROM lines WHERE category_name IS NOT NULL GROUP BY 1",
)
def _drop_null(spark, sf_dir):
    kept = fx.lines(spark, sf_dir).na.drop(subset=["category_name"])
    return kept.groupBy("category_name").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "dedup_rows",
    "SELECT kot_no, restaurant_name, source_file FROM headers",
)
def _dedup(spark, sf_dir):
    return cleanse.remove_duplicates(raw_headers(spark, sf_dir)).select(
        F.col("KOT No").alias("kot_no"),
        F.trim(F.regexp_replace("Restaurant Name", "\t", "")).alias("restaurant_name"),
        "source_file",
    )


@query(
    "distinct_values",
    "SELECT DISTINCT item_name, category_name FROM lines",
)
def _distinct(spark, sf_dir):
    return fx.lines(spark, sf_dir).select("item_name", "category_name").distinct()


@query(
    "union_files",
    "SELECT restaurant_name, invoice_no, order_type, CAST(NULL AS VARCHAR) AS item_name,"
    " CAST(total AS DOUBLE) AS total FROM headers UNION ALL SELECT restaurant_name, invoice_no,"
    " NULL, item_name, CAST(item_total AS DOUBLE) FROM lines",
)
def _union(spark, sf_dir):
    first = fx.headers(spark, sf_dir).select(
        "restaurant_name", "invoice_no", "order_type", "total"
    )
    second = fx.lines(spark, sf_dir).select(
        "item_name", F.col("item_total").alias("total"), "invoice_no", "restaurant_name"
    )
    return cleanse.union_files([first, second])


@query("silver_pipeline", f"SELECT {_TYPED}, source_file FROM headers")
def _silver(spark, sf_dir):
    return silver_pipeline(raw_headers(spark, sf_dir)).rows.select(
        *_TYPED_COLUMNS, "source_file"
    )


@query(
    "run_metrics",
    "SELECT source_file, count(*) AS rows_before, count(DISTINCT kot_no) AS rows_after,"
    f" count(*) - count(DISTINCT kot_no) AS duplicates_removed FROM {_RAW} GROUP BY 1",
)
def _metrics(spark, sf_dir):
    raw = raw_headers(spark, sf_dir)
    return run_metrics(raw, cleanse.remove_duplicates(raw))


# --- quality ----------------------------------------------------------------

_AS_OF = "2000-06-01"
_SIGNED = (*AMOUNTS, "service_charge", "additional_charge", "deduction_charge")
_MESSAGES = {
    "negative_values": "' contains ' || n || ' negative value(s).'",
    "duplicate_ids": "' has ' || n || ' duplicate identifier candidate value(s).'",
    "null_ids": "' has ' || n || ' null identifier value(s).'",
    "impossible_dates": "' contains ' || n || ' impossible date value(s)"
    " (before 1900-01-01 or in the future).'",
}


def _findings(rule: str, counts: str) -> str:
    return (
        f"SELECT source_file, '{rule}' AS rule, column_name, n,"
        f" 'Column ''' || column_name || '''{_MESSAGES[rule][1:]} AS message"
        f" FROM ({counts}) AS {rule}_counts WHERE n > 0"
    )


def _each(columns, select: str) -> str:
    return " UNION ALL ".join(
        select.replace("{c}", c) for c in columns
    )


_NEGATIVE = _findings(
    "negative_values",
    _each(
        _SIGNED,
        "SELECT source_file, '{c}' AS column_name, count(*) FILTER ({c} < 0) AS n"
        " FROM headers GROUP BY 1",
    ),
)
_DUPLICATE = _findings(
    "duplicate_ids",
    _each(
        ("invoice_no", "kot_no"),
        "SELECT source_file, '{c}' AS column_name, CAST(sum(k) AS BIGINT) AS n FROM"
        " (SELECT source_file, {c}, count(*) AS k FROM headers WHERE {c} IS NOT NULL"
        " GROUP BY 1, 2 HAVING count(*) > 1) AS t GROUP BY 1",
    ),
)
_IMPOSSIBLE = _findings(
    "impossible_dates",
    "SELECT source_file, 'date' AS column_name, count(*) FILTER"
    f" (date < TIMESTAMP '1900-01-01' OR date > TIMESTAMP '{_AS_OF}') AS n"
    " FROM headers GROUP BY 1",
)
_BY = ["source_file"]


def _as_of():
    return F.lit(_AS_OF).cast("timestamp_ntz")


@query(
    "dq_id_columns",
    "SELECT 'invoice_no' AS column_name, count(invoice_no) AS filled FROM headers"
    " UNION ALL SELECT 'kot_no', count(kot_no) FROM headers",
)
def _ids(spark, sf_dir):
    df = fx.headers(spark, sf_dir)
    columns = quality.id_columns(df)
    counts = df.agg(*[F.count(c).alias(c) for c in columns])
    return quality.long_format(counts, {c: F.col(c) for c in columns}, [], "column_name", "filled")


@query("dq_negative_values", _NEGATIVE)
def _negative(spark, sf_dir):
    return quality.negative_values(fx.headers(spark, sf_dir), _BY)


@query("dq_duplicate_ids", _DUPLICATE)
def _duplicates(spark, sf_dir):
    return quality.duplicate_ids(fx.headers(spark, sf_dir), _BY)


@query(
    "dq_null_ids",
    "SELECT 'customer_id' AS column_name, count(*) AS n, 'null_ids' AS rule,"
    " 'Column ''customer_id'' has ' || count(*) || ' null identifier value(s).' AS message"
    " FROM orders WHERE o_orderstatus = 'P'",
)
def _null_ids(spark, sf_dir):
    df = fx.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderkey").alias("order_no"),
    )
    return quality.null_ids(df)


@query("dq_impossible_dates", _IMPOSSIBLE)
def _dates(spark, sf_dir):
    return quality.impossible_dates(fx.headers(spark, sf_dir), _BY, _as_of())


@query("dq_report", " UNION ALL ".join([_NEGATIVE, _DUPLICATE, _IMPOSSIBLE]))
def _report(spark, sf_dir):
    return quality.quality_report(fx.headers(spark, sf_dir), _BY, _as_of())


# --- reconciliation ---------------------------------------------------------

_FACT_SOURCES = {"orders": "enriched", "order_items": "lines", "kitchen": "tickets"}


@query(
    "recon_row_counts",
    _each(
        ("orders", "order_items", "kitchen"),
        "SELECT '{c}' AS dataset, (SELECT count(*) FROM fact_{c}) AS fact_rows,"
        " (SELECT count(*) FROM source_{c}) AS source_rows,"
        " (SELECT count(*) FROM fact_{c}) = (SELECT count(*) FROM source_{c}) AS matches",
    )
    .replace("source_orders", "enriched")
    .replace("source_order_items", "lines")
    .replace("source_kitchen", "tickets"),
)
def _row_counts(spark, sf_dir):
    sources = {fact: getattr(fx, name)(spark, sf_dir) for fact, name in _FACT_SOURCES.items()}
    return reconcile.row_counts(fx.gold(spark, sf_dir).facts, sources)


def _key_sql(place: int) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS dimension, '{pair[place]}' AS key_column, count(*) AS rows,"
        f" count(*) - count(DISTINCT {pair[place]}) - count(*) FILTER"
        f" ({pair[place]} IS NULL) AS duplicate_rows FROM dim_{name}"
        for name, pair in LOOKUPS.items()
    )


@query("recon_surrogate_unique", _key_sql(1))
def _surrogates(spark, sf_dir):
    return reconcile.key_duplicates(fx.gold(spark, sf_dir).dimensions, surrogate=True)


@query("recon_business_unique", _key_sql(0))
def _business(spark, sf_dir):
    return reconcile.key_duplicates(fx.gold(spark, sf_dir).dimensions, surrogate=False)


@query(
    "recon_null_keys",
    " UNION ALL ".join(
        f"SELECT '{fact}' AS fact, '{c}' AS key_column, count(*) AS rows,"
        f" count(*) - count({c}) AS nulls FROM fact_{fact}"
        for fact, schema in FACTS.items()
        for c in schema
        if c.endswith("_key")
    ),
)
def _null_keys(spark, sf_dir):
    return reconcile.null_keys(fx.gold(spark, sf_dir).facts)


_SHAPES = {f"dim_{n}": (LOOKUPS[n][1], *DIMENSIONS[n][1]) for n in DIMENSIONS} | {
    f"fact_{n}": tuple(schema) for n, schema in FACTS.items()
}


@query(
    "recon_columns",
    " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, '{','.join(columns)}' AS columns, true AS matches,"
        f" count(*) AS rows FROM {t}"
        for t, columns in _SHAPES.items()
    ),
)
def _columns(spark, sf_dir):
    return reconcile.column_shapes(fx.gold(spark, sf_dir).tables(), _SHAPES)


@query(
    "lookup_failures",
    " UNION ALL ".join(
        f"SELECT '{fact}' AS fact, '{LOOKUPS[d][1]}' AS key_column,"
        f" CAST({LOOKUPS[d][0]} AS VARCHAR) AS business_value, count(*) AS failing_rows,"
        f" {ratio('100.0 * count(*)', f'(SELECT count(*) FROM {cte})')} AS failing_percent"
        f" FROM {cte} WHERE {LOOKUPS[d][1]} IS NULL GROUP BY 3"
        for fact, cte, dims in (
            ("orders", "keyed_orders", ("date", "restaurant", "brand", "platform")),
            ("order_items", "keyed_lines", tuple(LOOKUPS)),
            ("kitchen", "keyed_tickets", ("date", "item")),
        )
        for d in dims
    ),
)
def _failures(spark, sf_dir):
    dims = fx.gold(spark, sf_dir).dimensions
    orders = fx.enriched(spark, sf_dir)
    keyed = {
        "orders": orders,
        "order_items": attach_order_context(fx.lines(spark, sf_dir), orders),
        "kitchen": fx.tickets(spark, sf_dir).withColumn(
            "business_date", F.to_date("punch_time")
        ),
    }
    return cleanse.union_files(
        reconcile.lookup_failures(attach_dimension_keys(df, dims), fact)
        for fact, df in keyed.items()
    )


@query(
    "orphan_lines",
    "SELECT 'line without header' AS finding, restaurant_name, invoice_no, count(*) AS rows"
    " FROM lines l WHERE NOT EXISTS (SELECT 1 FROM headers h WHERE h.invoice_no = l.invoice_no"
    " AND h.restaurant_name = l.restaurant_name) GROUP BY ALL UNION ALL"
    " SELECT 'repeated header', restaurant_name, invoice_no, count(*) FROM headers"
    " GROUP BY ALL HAVING count(*) > 1",
)
def _orphans(spark, sf_dir):
    return reconcile.orphan_lines(fx.lines(spark, sf_dir), fx.headers(spark, sf_dir))


# --- profiles ---------------------------------------------------------------


def _percent(part: str, whole: str) -> str:
    return f"COALESCE({ratio(f'100.0 * ({part})', whole)}, 0.0)"


_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double",
    "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


def _column_sql(c: str, dtype: str, table: str) -> str:
    return (
        f"SELECT '{c}' AS column_name, '{dtype}' AS dtype, count(*) - count({c}) AS null_count,"
        f" {_percent(f'count(*) - count({c})', 'count(*)')} AS null_percent,"
        f" count(DISTINCT {c}) AS distinct_count,"
        f" {_percent(f'count(DISTINCT {c})', 'count(*)')} AS distinct_percent FROM {table}"
    )


def _numeric_sql(c: str, table: str) -> str:
    total = f"SUM(CAST({c} AS DECIMAL(28,6)))"
    return (
        f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min,"
        f" CAST(max({c}) AS DOUBLE) AS max, {ratio(total, f'count({c})', 4)} AS mean,"
        f" {r(f'median(CAST({c} AS DOUBLE))', 4)} AS median,"
        f" count(*) FILTER ({c} < 0) AS negative_values,"
        f" count(*) FILTER ({c} = 0) AS zero_values FROM {table} HAVING count({c}) > 0"
    )


def _duplicate_sql(table: str) -> str:
    return (
        "SELECT CAST(sum(k) AS BIGINT) AS rows, CAST(sum(k - 1) AS BIGINT) AS duplicate_rows,"
        f" {_percent('sum(k - 1)', 'sum(k)')} AS duplicate_percent"
        f" FROM (SELECT count(*) AS k FROM {table} GROUP BY ALL) AS t"
    )


@query(
    "profile_columns",
    " UNION ALL ".join(_column_sql(c, t, "lineitem") for c, t in _TYPES.items()),
)
def _profile_columns(spark, sf_dir):
    return profile.profile_columns(fx.table(spark, sf_dir, "lineitem"))


@query(
    "profile_duplicates",
    _duplicate_sql("(SELECT l_returnflag, l_linestatus, l_shipdate, l_quantity FROM lineitem)")
    .replace("count(*) AS k FROM (", "l_returnflag, l_linestatus, l_shipdate, l_quantity, count(*) AS k FROM (")
    .replace("GROUP BY ALL) AS t", "AS s GROUP BY ALL) AS t"),
)
def _profile_duplicates(spark, sf_dir):
    df = fx.table(spark, sf_dir, "lineitem")
    return profile.profile_duplicates(
        df.select("l_returnflag", "l_linestatus", "l_shipdate", "l_quantity")
    )


_NUMERIC = [c for c, t in _TYPES.items() if t in ("bigint", "int", "double")]


@query("profile_numeric", " UNION ALL ".join(_numeric_sql(c, "lineitem") for c in _NUMERIC))
def _profile_numeric(spark, sf_dir):
    return profile.profile_numeric(fx.table(spark, sf_dir, "lineitem"))


@query(
    "profile_dates",
    "SELECT 'punch_time' AS column_name, min(punch_time) AS min_date, max(punch_time) AS max_date"
    " FROM tickets UNION ALL SELECT 'prepared_time', min(prepared_time), max(prepared_time)"
    " FROM tickets",
)
def _profile_dates(spark, sf_dir):
    return profile.profile_dates(fx.tickets(spark, sf_dir))


_DATASETS = {
    "order_summary": (
        "headers",
        (
            "restaurant_name", "invoice_no", "kot_no", "date", "sub_order_type", "order_type",
            "status", "order_cancel_reason", *_SIGNED, "source_file",
        ),
        _SIGNED,
    ),
    "order_summary_item": (
        "lines",
        (
            "restaurant_name", "invoice_no", "item_name", "category_name", "item_quantity",
            "item_price", "item_total", "source_file",
        ),
        ("item_quantity", "item_price", "item_total"),
    ),
    "kot_process_time": (
        "tickets",
        (
            "kot_id", "punch_time", "prepared_time", "order_type", "server_name", "item_name",
            "item_status", "qty", "price", "preparation_time_taken_mins",
        ),
        ("kot_id", "qty", "price", "preparation_time_taken_mins"),
    ),
}


# Types of the bound columns that are not text.
_BOUND_TYPES = {
    "order_summary": {
        "date": "timestamp_ntz", "my_amount": "decimal(19,2)",
        **dict.fromkeys(
            ("total_tax", "discount", "delivery_charge", "container_charge",
             "waived_off", "round_off", "total"), "decimal(18,2)",
        ),
        **dict.fromkeys(("service_charge", "additional_charge", "deduction_charge"), "bigint"),
    },
    "order_summary_item": {
        "item_quantity": "double", "item_price": "decimal(18,2)", "item_total": "decimal(18,2)",
    },
    "kot_process_time": {
        "kot_id": "bigint", "punch_time": "timestamp_ntz", "prepared_time": "timestamp_ntz",
        "qty": "double", "price": "decimal(18,2)", "preparation_time_taken_mins": "decimal(18,2)",
    },
}


def _unpivot(dataset: str, select: str, metrics: tuple[str, ...], column: str) -> str:
    casts = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in metrics)
    return (
        f"SELECT '{dataset}' AS dataset, column_name, metric, value,"
        " CAST(NULL AS VARCHAR) AS text FROM"
        f" (UNPIVOT (SELECT {column} AS column_name, {casts} FROM ({select}) AS figures)"
        f" ON {', '.join(metrics)} INTO NAME metric VALUE value)"
    )


def _dataset_sql(dataset: str) -> str:
    cte, columns, numbers = _DATASETS[dataset]
    listed = ", ".join(columns)
    whole = (
        "SELECT rows, columns, duplicate_rows, duplicate_percent FROM (SELECT "
        f"{len(columns)} AS columns, CAST(sum(k) AS BIGINT) AS rows,"
        f" CAST(sum(k - 1) AS BIGINT) AS duplicate_rows,"
        f" {_percent('sum(k - 1)', 'sum(k)')} AS duplicate_percent FROM"
        f" (SELECT {listed}, count(*) AS k FROM {cte} GROUP BY ALL) AS t) AS w"
    )
    per_column = " UNION ALL ".join(_column_sql(c, "", cte) for c in columns)
    per_number = " UNION ALL ".join(_numeric_sql(c, cte) for c in numbers)
    texts = [(c, "dtype", f"'{_BOUND_TYPES[dataset].get(c, 'string')}'", "") for c in columns]
    for c, kind in _BOUND_TYPES[dataset].items():
        if kind == "timestamp_ntz":
            shown = f"rtrim(rtrim(strftime({{}}({c}), '%Y-%m-%d %H:%M:%S.%f'), '0'), '.')"
            texts += [(c, f"{f}_date", shown.format(f), f" FROM {cte}") for f in ("min", "max")]
    return " UNION ALL ".join(
        [
            f"SELECT '{dataset}' AS dataset, '{c}' AS column_name, '{metric}' AS metric,"
            f" CAST(NULL AS DOUBLE) AS value, {text} AS text{source}"
            for c, metric, text, source in texts
        ]
        + [
            _unpivot(
                dataset, whole, ("rows", "columns", "duplicate_rows", "duplicate_percent"), "'*'"
            ),
            _unpivot(
                dataset, per_column,
                ("null_count", "null_percent", "distinct_count", "distinct_percent"),
                "column_name",
            ),
            _unpivot(
                dataset, per_number,
                ("min", "max", "mean", "median", "negative_values", "zero_values"),
                "column_name",
            ),
        ]
    )


@query("profile_datasets", " UNION ALL ".join(_dataset_sql(d) for d in _DATASETS))
def _profile_all(spark, sf_dir):
    return profile.profile_datasets(
        {name: getattr(fx, cte)(spark, sf_dir) for name, (cte, _, _) in _DATASETS.items()}
    )


# --- dashboard figures ------------------------------------------------------

_SOLD = (
    "(SELECT f.* FROM fact_orders f JOIN dim_date USING (date_key)"
    " JOIN dim_platform USING (platform_key)"
    " WHERE year >= 1997 AND platform IN ('Zomato', 'Swiggy')) AS sold"
)
_COOKED = (
    "(SELECT f.* FROM fact_kitchen f JOIN dim_date USING (date_key) WHERE year >= 1997) AS cooked"
)
_MINUTES = "preparation_time_taken_mins"


@query(
    "kpi_cards",
    " UNION ALL ".join(
        f"SELECT '{card}' AS card, {value} AS value FROM {source}"
        for card, value, source in (
            ("Net Sales", "CAST(SUM(total) AS DOUBLE)", _SOLD),
            ("Gross Sales", "CAST(SUM(my_amount) AS DOUBLE)", _SOLD),
            ("Orders", "CAST(COUNT(DISTINCT invoice_no) AS DOUBLE)", _SOLD),
            ("Average Order Value", ratio("SUM(total)", "COUNT(DISTINCT invoice_no)"), _SOLD),
            ("Average Discount %", ratio("100.0 * SUM(discount)", "SUM(my_amount)"), _SOLD),
            ("Tax", "CAST(SUM(total_tax) AS DOUBLE)", _SOLD),
            ("Average Preparation Time", ratio(f"SUM({_MINUTES})", f"COUNT({_MINUTES})"), _COOKED),
            ("Kitchen Tickets", "CAST(COUNT(DISTINCT kot_id) AS DOUBLE)", _COOKED),
            (
                "Slow Kitchen Tickets",
                f"CAST(COUNT(DISTINCT kot_id) FILTER ({_MINUTES} >= 15) AS DOUBLE)",
                _COOKED,
            ),
        )
    ),
)
def _kpi(spark, sf_dir):
    return kpi_cards(
        fx.gold(spark, sf_dir).tables(),
        dates=F.col("year") >= 1997,
        platforms=F.col("platform").isin("Zomato", "Swiggy"),
    )
