"""Queries over sources, the ledger and sinks, on files Spark derives from the tables."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import functions as F

from ..operators.cleanse import standardize_columns, union_files
from ..plans.batch import run_batch
from ..plans.views import VIEWS, create_views
from ..session import scratch_path
from ..sinks import layers, reports, warehouse
from ..sources import csv_files, intake, landing, workbook
from . import fixtures as fx
from .base import query
from .raw import landing as landing_root
from .star import _STORED as STORED
from .star import VIEW_ORACLES

# --- discovery and CSV ------------------------------------------------------

_COPIED = "SUM(CASE WHEN service_charge = 3 THEN 2 ELSE 1 END)"
_RAW = (
    "(SELECT h.* FROM headers h,"
    " LATERAL range(1, 1 + CASE WHEN service_charge = 3 THEN 2 ELSE 1 END)) AS raw"
)


def _csv(spark, sf_dir, report):
    found = landing.discover_reports(spark, landing_root(spark, sf_dir))
    return found.filter(F.col("report") == report)


@query(
    "scan_discover",
    f"SELECT 'order_summary' AS report, 'csv' AS extension, CAST({_COPIED} AS BIGINT) AS rows"
    " FROM headers UNION ALL SELECT 'order_summary_item', 'csv', count(*) FROM lines"
    " UNION ALL SELECT 'kot_process_time', 'csv', count(*) FROM tickets",
)
def _discover(spark, sf_dir):
    found = landing.discover_reports(spark, landing_root(spark, sf_dir))
    reports_found = [r.report for r in found.select("report").distinct().collect()]
    counts = [
        csv_files.read_csv_files(found.filter(F.col("report") == name))[0]
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("report"), F.lit("csv").alias("extension"), "rows")
        for name in reports_found
    ]
    return union_files(counts)


@query(
    "scan_csv",
    "SELECT kot_no, concat('  ', restaurant_name, chr(9)) AS restaurant_name,"
    " COALESCE(sub_order_type, 'None') AS sub_order_type, CAST(total AS VARCHAR) AS total,"
    f" COALESCE(order_cancel_reason, '--') AS order_cancel_reason FROM {_RAW}",
)
def _scan_csv(spark, sf_dir):
    rows, _ = csv_files.read_csv_files(_csv(spark, sf_dir, "order_summary"))
    return standardize_columns(rows).select(
        "kot_no", "restaurant_name", "sub_order_type", "total", "order_cancel_reason"
    )


_BAD = (csv_files.TOO_WIDE, intake.UNCLOSED, intake.TOO_MANY)


def _write_lines(df, path):
    """Append rows of one text column to a folder of CSV files as they stand."""
    raw = df.write.mode("append").format("csv")
    raw.options(header=False, quote="", escape="", sep="\x01").save(path)


@query(
    "scan_isolate_bad_files",
    "SELECT restaurant_name, CAST(invoice_no AS VARCHAR) AS invoice_no, item_name,"
    " NULL AS named_source_file, NULL AS reason FROM lines"
    " UNION ALL SELECT NULL, CAST(o_orderkey AS VARCHAR), NULL, o_orderpriority, NULL FROM orders"
    " UNION ALL SELECT NULL, NULL, NULL, NULL, reason"
    f" FROM (VALUES {', '.join(f'({r!r})' for r in _BAD)}) AS bad(reason)",
)
def _isolate(spark, sf_dir):
    """Files of every kind of bad header beside good ones, one with a column called as ours."""
    root = scratch_path(spark, "isolate")
    folder = f"{root}/order_summary_item"
    orders = fx.table(spark, sf_dir, "orders")
    lines = fx.lines(spark, sf_dir).select("restaurant_name", "invoice_no", "item_name")
    lines.write.csv(folder, header=True)
    named = orders.select(F.col("o_orderkey").alias("invoice_no"), F.col("o_orderpriority").alias("source_file"))
    named.write.mode("append").csv(folder, header=True)
    # Every block starts with a two-column header and goes on with three cells. A block is
    # staged as one record, so that no file begins inside it.
    block = F.concat(F.lit("order,customer\n"), F.concat_ws(",", "o_orderkey", "o_custkey", "o_custkey"))
    staged = {"lineSep": "\x02", "compression": "none"}
    orders.select(block).write.options(**staged).text(f"{root}/staged")
    blocks = spark.read.options(**staged).text(f"{root}/staged")
    _write_lines(blocks.select(F.explode(F.split("value", "\n"))), folder)
    one = orders.agg(F.max("o_orderkey").cast("string").alias("last"))
    wide = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(25_000)), lambda i: F.concat(F.lit("c"), i)), ",")
    for header in (F.lit('"order,customer'), wide):
        _write_lines(one.select(F.explode(F.array(header, "last"))), folder)
    rows, aside = csv_files.read_csv_files(landing.discover_reports(spark, root))
    read = rows.select(
        "restaurant_name", "invoice_no", "item_name",
        F.col("`source_file.1`").alias("named_source_file"),
        F.lit(None).cast("string").alias("reason"),
    )
    return read.unionByName(aside.select("reason").distinct(), allowMissingColumns=True)


@query(
    "lineage_columns",
    "SELECT 'order_summary_item' AS report, true AS named, count(*) AS rows FROM lines",
)
def _lineage(spark, sf_dir):
    rows, _ = csv_files.read_csv_files(_csv(spark, sf_dir, "order_summary_item"))
    parts = F.split("source_path", "/")
    named = (F.element_at(parts, -1) == F.col("source_file")).alias("named")
    return rows.groupBy(F.element_at(parts, -2).alias("report"), named).agg(
        F.count(F.lit(1)).alias("rows")
    )


# --- workbooks --------------------------------------------------------------

_BOOK_ROWS = 500
_COLUMNS = ("KOT No", "Item Name", "Qty", "Preparation Time Taken (Mins)", "Remarks")

# Grid rows as '|'-joined cells: a title, metadata and a header whose place and
# wording vary by book, then the events of the book. ~ stands for an empty cell.
_BOOK = f"CAST(floor(event_id / {_BOOK_ROWS}) AS BIGINT)"
_PATH = "concat('kot_', CAST(book AS STRING), '.xlsx')"
_META = (
    (0, "'KOT Process Time Report|~|~|~|~'"),
    (1, "'~|~|~|~|~'"),
    (2, "concat('Period|', CAST(book AS STRING), '|~|~|~')"),
    (3, "CASE WHEN book % 2 = 0 THEN '{columns}' ELSE 'Outlet|Total Time|~|~|~' END"),
    (4, "CASE WHEN book % 2 = 0 THEN '~|~|~|~|~' ELSE '{columns}' END"),
)
GRID_SQL = " UNION ALL ".join(
    [
        f"SELECT {_PATH} AS path, {i} AS row_idx, "
        + text.replace("{columns}", "|".join(_COLUMNS))
        + f" AS line FROM (SELECT DISTINCT {_BOOK} AS book FROM {{events}}) AS b{i}"
        for i, text in _META
    ]
    + [
        f"SELECT {_PATH} AS path, CAST(event_id % {_BOOK_ROWS} + 5 AS INT) AS row_idx,"
        " concat(CAST(event_id AS STRING), '|', event_type, '|',"
        " CAST(user_id AS STRING), '|', CAST(CAST(floor(value) AS BIGINT) AS STRING), '|~') AS line"
        f" FROM (SELECT *, {_BOOK} AS book FROM {{events}}) AS e"
    ]
)
_GRID_ORACLE = f"({GRID_SQL.format(events='events')}) AS grid"


def _grid(spark, sf_dir):
    rows = spark.sql(GRID_SQL, events=fx.table(spark, sf_dir, "events"))
    cells = F.transform(F.split("line", "[|]"), lambda c: F.when(c != "~", c))
    return rows.select("path", F.col("row_idx").cast("int"), cells.alias("cells"))


def _pack(batches):
    """One small workbook per batch of rows (path, row_idx, cells)."""
    for number, batch in enumerate(batches):
        rows = []
        for position, cells in enumerate(batch["cells"], start=1):
            texts = [
                "<c/>" if c is None else f'<c t="inlineStr"><is><t>{escape(c)}</t></is></c>'
                for c in cells
            ]
            rows.append(f'<row r="{position}">{"".join(texts)}</row>')
        sheet = (
            '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
            f'<sheetData>{"".join(rows)}</sheetData></worksheet>'
        )
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as book:
            book.writestr("xl/worksheets/sheet1.xml", sheet)
        yield pd.DataFrame({"path": [f"book_{number}.xlsx"], "content": [packed.getvalue()]})


def _cell_sql(position: int) -> str:
    return f"nullif(string_split(line, '|')[{position}], '~')"


@query(
    "scan_workbook_grid",
    f"SELECT {_cell_sql(1)} AS first_cell, {_cell_sql(2)} AS second_cell,"
    f" {_cell_sql(4)} AS fourth_cell FROM {_GRID_ORACLE}",
)
def _workbook_grid(spark, sf_dir):
    books = _grid(spark, sf_dir).mapInPandas(_pack, "path string, content binary")
    grid = workbook.workbook_grid(books)
    return grid.select(
        F.get("cells", F.lit(0)).alias("first_cell"),
        F.get("cells", F.lit(1)).alias("second_cell"),
        F.get("cells", F.lit(3)).alias("fourth_cell"),
    )


_WORDS = ", ".join(f"'{w}'" for w in workbook.HEADER_WORDS)
_SCORED = (
    "SELECT path, row_idx, line, CASE WHEN len(cells) >= 2 THEN"
    f" len(list_filter([{_WORDS}], lambda w: len(list_filter(cells, lambda c: contains(c, w))) > 0))"
    " ELSE 0 END AS score FROM (SELECT path, row_idx, line,"
    " list_distinct(list_filter(string_split(lower(line), '|'), lambda c: c <> '~')) AS cells"
    f" FROM {_GRID_ORACLE} WHERE row_idx < 30) AS cut"
)
_BEST = (
    "SELECT path, row_idx AS header_idx, score, line FROM (SELECT *, row_number() OVER"
    f" (PARTITION BY path ORDER BY score DESC, row_idx) AS place FROM ({_SCORED}) AS scored)"
    " AS ranked WHERE place = 1 AND score > 0"
)


@query(
    "header_row_detect",
    f"SELECT path, CAST(header_idx AS BIGINT) AS header_idx, CAST(score AS BIGINT) AS score,"
    f" replace(replace(line, '|~', ''), '|', '; ') AS header FROM ({_BEST}) AS best",
)
def _detect(spark, sf_dir):
    return workbook.detect_header_row(_grid(spark, sf_dir))


@query(
    "limit_scan",
    f"SELECT path, count(*) AS rows, max(row_idx) AS last_row FROM {_GRID_ORACLE}"
    " WHERE row_idx < 30 GROUP BY 1",
)
def _leading(spark, sf_dir):
    leading = workbook.leading_rows(_grid(spark, sf_dir))
    return leading.groupBy("path").agg(
        F.count(F.lit(1)).alias("rows"), F.max("row_idx").alias("last_row")
    )


@query(
    "header_promote",
    "SELECT path, string_split(line, '|')[1] AS kot_no, string_split(line, '|')[2] AS item_name,"
    " string_split(line, '|')[3] AS qty, string_split(line, '|')[4] AS minutes,"
    f" 5 AS columns FROM {_GRID_ORACLE} WHERE row_idx >= 5",
)
def _promote(spark, sf_dir):
    grid = _grid(spark, sf_dir)
    rows = workbook.promote_header(grid, workbook.detect_header_row(grid))
    # The all-blank Remarks column is gone: path and four columns are left.
    return rows.drop("row_idx").select(
        "path", F.col("KOT No").alias("kot_no"), F.col("Item Name").alias("item_name"),
        F.col("Qty").alias("qty"), F.col("Preparation Time Taken (Mins)").alias("minutes"),
        F.lit(len(rows.columns) - 1).alias("columns"),
    )


# --- ledger -----------------------------------------------------------------

# Documents as files. The ledger saw an older text of every third one, and
# knew German ones under another name.
_FILE = "concat('doc_', CAST(doc_id AS VARCHAR), '.txt')"
_KNOWN = f"CASE WHEN lang = 'de' THEN concat('alt_', {_FILE}) ELSE {_FILE} END"
_OLD = "CASE WHEN doc_id % 3 = 0 THEN text || '!' ELSE text END"
_HASHED = f"SELECT source AS report, {_FILE} AS file_name, sha256(text) AS hash FROM documents"
_LEDGER = (
    f"SELECT source AS report, {_KNOWN} AS file_name, sha256({_OLD}) AS hash,"
    " TIMESTAMP '2024-01-01 00:00:00' AS processed_time FROM documents"
)


def _documents(spark, sf_dir):
    text = F.col("text")
    return fx.table(spark, sf_dir, "documents").select(
        F.col("source").alias("report"),
        F.concat(F.lit("doc_"), "doc_id", F.lit(".txt")).alias("file_name"),
        F.encode(text, "UTF-8").alias("content"),
        F.encode(
            F.when(F.col("doc_id") % 3 == 0, F.concat(text, F.lit("!"))).otherwise(text), "UTF-8"
        ).alias("older"),
        "lang",
    )


def _ledger(files):
    name = F.when(F.col("lang") == "de", F.concat(F.lit("alt_"), "file_name")).otherwise(
        F.col("file_name")
    )
    past = files.select("report", name.alias("file_name"), F.col("older").alias("content"))
    return landing.content_hash(past).select(
        "report", "file_name", "hash",
        F.lit("2024-01-01").cast("timestamp").alias("processed_time"),
    )


@query("content_hash", _HASHED)
def _hash(spark, sf_dir):
    return landing.content_hash(_documents(spark, sf_dir)).select("report", "file_name", "hash")


@query(
    "changed_files",
    f"SELECT f.* FROM ({_HASHED}) AS f LEFT JOIN ({_LEDGER}) AS k ON k.report = f.report"
    " AND k.file_name = f.file_name WHERE k.hash IS NULL OR k.hash <> f.hash",
)
def _changed(spark, sf_dir):
    files = _documents(spark, sf_dir)
    hashed = landing.content_hash(files).select("report", "file_name", "hash")
    return landing.changed_files(hashed, _ledger(files))


@query(
    "ledger_anti_join",
    f"SELECT report, count(*) AS files FROM (SELECT * FROM ({_HASHED}) AS f WHERE NOT EXISTS"
    f" (SELECT 1 FROM ({_LEDGER}) AS k WHERE k.report = f.report AND k.file_name = f.file_name"
    " AND k.hash = f.hash)) AS t GROUP BY 1",
)
def _anti(spark, sf_dir):
    files = _documents(spark, sf_dir)
    changed = landing.changed_files(landing.content_hash(files), _ledger(files))
    return changed.groupBy("report").agg(F.count(F.lit(1)).alias("files"))


@query(
    "ledger_upsert",
    f"SELECT report, file_name, hash, processed_time FROM ({_LEDGER}) AS k WHERE NOT EXISTS"
    f" (SELECT 1 FROM ({_HASHED}) AS f WHERE f.report = k.report AND f.file_name = k.file_name)"
    f" UNION ALL SELECT *, TIMESTAMP '2024-02-01 00:00:00' FROM ({_HASHED}) AS f",
)
def _upsert(spark, sf_dir):
    files = _documents(spark, sf_dir)
    entries = landing.content_hash(files).select(
        "report", "file_name", "hash",
        F.lit("2024-02-01").cast("timestamp").alias("processed_time"),
    )
    return landing.ledger_upsert(_ledger(files), entries)


# --- layers, warehouse, reports ---------------------------------------------

_PER_FILE = (
    "SELECT source_file, count(*) AS rows, CAST(SUM(item_total) AS DOUBLE) AS item_total"
    " FROM lines {where} GROUP BY 1"
)


def _per_file(df):
    return df.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("item_total").alias("item_total")
    )


@query("sink_bronze", _PER_FILE.format(where=""))
def _bronze(spark, sf_dir):
    root = scratch_path(spark, "bronze")
    layers.write_report(fx.lines(spark, sf_dir), root, "order_summary_item", overwrite=False)
    # Writing the same files again replaces them.
    layers.write_report(fx.lines(spark, sf_dir), root, "order_summary_item")
    return _per_file(layers.read_report(spark, root, "order_summary_item"))


_FILES = ("items_1996.csv", "items_1999.csv")


@query("scan_bronze", _PER_FILE.format(where=f"WHERE source_file IN {_FILES}"))
def _scan_bronze(spark, sf_dir):
    root = scratch_path(spark, "bronze")
    layers.write_report(fx.lines(spark, sf_dir), root, "order_summary_item")
    return _per_file(layers.read_report(spark, root, "order_summary_item", _FILES))


@query(
    "sink_silver",
    "SELECT kot_no, source_file, brand, business_date, business_validation_errors FROM enriched",
)
def _silver(spark, sf_dir):
    root = scratch_path(spark, "silver")
    layers.write_report(fx.enriched(spark, sf_dir), root, "order_summary")
    return layers.read_report(spark, root, "order_summary").select(
        "kot_no", "source_file", "brand", "business_date", "business_validation_errors"
    )


_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS dataset, count(*) AS rows FROM {t}" for t in STORED)


@query("sink_gold", _COUNTS)
def _sink_gold(spark, sf_dir):
    return layers.write_tables(fx.gold(spark, sf_dir).tables(), scratch_path(spark, "gold"))


def _stored(spark, sf_dir, prefix):
    root = scratch_path(spark, "warehouse")
    warehouse.write_warehouse(fx.gold(spark, sf_dir).tables(), root)
    return warehouse.open_warehouse(spark, root, tuple(STORED), prefix)


def _row_counts(spark, names, prefix):
    return union_files(
        spark.table(prefix + name)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("dataset"), "rows")
        for name in names
    )


@query("warehouse_tables", _COUNTS)
def _warehouse(spark, sf_dir):
    _stored(spark, sf_dir, "stored_")
    return _row_counts(spark, STORED, "stored_")


@query(
    "warehouse_views",
    " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, count(*) AS rows FROM ({VIEW_ORACLES[name]}) AS {name}"
        for name in VIEWS
    ),
)
def _views(spark, sf_dir):
    create_views(spark, fx.gold(spark, sf_dir).tables(), "live_")
    return _row_counts(spark, VIEWS, "live_")


@query("sink_csv_report", VIEW_ORACLES["vw_daily_sales"])
def _csv_report(spark, sf_dir):
    create_views(spark, fx.gold(spark, sf_dir).tables(), "live_")
    df, path = spark.table("live_vw_daily_sales"), scratch_path(spark, "report")
    order = [F.col("business_date").asc_nulls_last(), F.col("restaurant_name").asc_nulls_last()]
    reports.publish_csv(df, path, order)
    back = spark.read.csv(path, header=True, escape='"', schema=df.schema)
    return back


@query(
    "publish_all",
    " UNION ALL ".join(
        [
            f"SELECT '{name}' AS dataset, 'view' AS kind, count(*) AS rows"
            f" FROM ({VIEW_ORACLES[name]}) AS {name}"
            for name in VIEWS
        ]
        + [
            f"SELECT '{t}', 'dimension', count(*) FROM {t}"
            for t in STORED
            if t.startswith("dim_")
        ]
    ),
)
def _publish(spark, sf_dir):
    tables = _stored(spark, sf_dir, "published_")
    return reports.publish_all(tables, scratch_path(spark, "reporting"))


@query("run_batch", _COUNTS)
def _batch(spark, sf_dir):
    """Landing folder to reports in one go; the warehouse holds the same star schema."""
    lake = scratch_path(spark, "lake")
    return run_batch(spark, landing_root(spark, sf_dir), lake).tables
