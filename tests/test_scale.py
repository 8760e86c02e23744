"""Plans and sides of joins that have to hold on tables much larger than these."""

import datetime
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from tillmart import session
from tillmart.operators import profile
from tillmart.operators.lookup import lookup_key
from tillmart.registry import QUERIES, fixtures, raw
from tillmart.sources import csv_files, landing, workbook


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def grid(spark):
    """Three workbooks, of two layouts and of none."""
    rows = [
        ("a", 0, ["title", None]), ("a", 1, ["Item", "Qty"]), ("a", 2, ["tea", "1"]), ("a", 3, [None, None]),
        ("b", 0, ["Qty", "Outlet"]), ("b", 1, ["2", "x"]), ("b", 2, ["3", None]),
        ("c", 0, ["1", "2"]), ("c", 1, None),
    ]
    return spark.createDataFrame(rows, "path string, row_idx int, cells array<string>")


def test_header_scores_stay_above_the_grid(grid):
    """The score, with all its words, is not pushed as a filter onto every row of the source."""
    found = workbook.detect_header_row(grid)
    assert {(r.path, r.header_idx, r.score, *r.header) for r in found.collect()} == {
        ("a", 1, 2, "Item", "Qty"), ("b", 0, 2, "Qty", "Outlet"),
    }
    filters = [line for line in _plan(found).splitlines() if "Filter" in line]
    assert not any("exists" in line for line in filters)


@pytest.mark.parametrize("books", [0, 100_000])
def test_grid_is_never_broadcast(grid, monkeypatch, books):
    monkeypatch.setattr(workbook, "BROADCAST_BOOKS", books, raising=False)
    rows = workbook.promote_header(grid, workbook.detect_header_row(grid))
    assert rows.columns == ["path", "row_idx", "Item", "Qty", "Outlet"]
    assert {tuple(r) for r in rows.collect()} == {
        ("a", 2, "tea", "1", None), ("b", 1, None, "2", "x"), ("b", 2, None, "3", None),
    }
    plan = _plan(rows)
    assert "BuildLeft" not in plan
    assert ("SortMergeJoin [path" in plan) is (books == 0)


def test_text_keys_are_not_broadcast(spark, sf_dir):
    found = QUERIES["key_to_string"](spark, sf_dir)
    assert "BroadcastHashJoin" not in _plan(found)
    assert found.agg(F.sum("lines")).first()[0] > 0


@pytest.mark.parametrize("wide", [False, True])
def test_read_rows_are_not_shuffled_for_wide_files(spark, tmp_path, wide):
    """Wide files are found first; even without any broadcast by size no row is shuffled."""
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "good.csv").write_text("a,b\n1,2\n3,4\n")
    (tmp_path / "r" / "other.csv").write_text("a,b\n5,6\n" + "7,8,9\n" * wide)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows, aside = csv_files.read_csv_files(landing.discover_reports(spark, str(tmp_path)))
        assert "Exchange hashpartitioning" not in _plan(rows)
        assert rows.columns == ["a", "b", "source_file", "source_path"]
        good = {("1", "2", "good.csv"), ("3", "4", "good.csv")}
        assert {tuple(r)[:3] for r in rows.collect()} == good | ({("5", "6", "other.csv")} if not wide else set())
        assert [(r.source_file, r.reason) for r in aside.collect()] == [("other.csv", csv_files.TOO_WIDE)] * wide
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_datasets_are_profiled_side_by_side(spark, monkeypatch):
    both = Barrier(2, timeout=30)

    def met(df, name):
        both.wait()
        return df.withColumn("dataset", F.lit(name))

    monkeypatch.setattr(profile, "profile_dataset", met)
    found = profile.profile_datasets({"a": spark.range(1), "b": spark.range(2)})
    assert [r.dataset for r in found.orderBy("dataset").collect()] == ["a", "b", "b"]


def test_header_texts_are_parsed_once(spark, sf_dir):
    """The facts read enriched headers; lines meet them by number first, never by broadcast."""
    facts = fixtures.gold(spark, sf_dir).facts
    for fact in facts.values():
        assert "regexp" not in fact._jdf.queryExecution().optimizedPlan().toString()
    line = next(x for x in _plan(facts["order_items"]).splitlines() if "SortMergeJoin" in x)
    assert line.index("invoice_no") < line.index("restaurant_name")
    assert facts["orders"].count() == fixtures.headers(spark, sf_dir).count()


@pytest.fixture(scope="module")
def many_parts(spark, tmp_path_factory):
    """Tables of few rows beside parts whose rows are few bytes in a file and many in memory."""
    root = tmp_path_factory.mktemp("many-parts")
    day = datetime.datetime(2020, 1, 2)
    part = spark.range(200_000).select(
        F.col("id").alias("p_partkey"),
        F.repeat(F.lit("tea "), 100).alias("p_name"), F.repeat(F.lit("hot "), 8).alias("p_type"),
    )
    tables = {
        "part": part,
        "nation": spark.createDataFrame([(i, f"N{i}") for i in range(25)], "n_nationkey int, n_name string"),
        "orders": spark.createDataFrame(
            [(i, i, "O", 10.0, day, "5-LOW") for i in range(40)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
            " o_orderdate timestamp_ntz, o_orderpriority string",
        ),
        "lineitem": spark.createDataFrame(
            [(i % 40, i * 1_999 if i % 9 else None, 2.0, 10.0, day) for i in range(100)],
            "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double,"
            " l_shipdate timestamp_ntz",
        ),
        "events": spark.createDataFrame(
            [(i, day, i * 6_000 if i % 3 else None, "view", 1.0) for i in range(30)],
            "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
        ),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_large_rows_in_small_files_are_merged(spark, many_parts):
    """The size of rows decides, not that of files; the other side is not sent instead."""
    part = fixtures.table(spark, many_parts, "part")
    assert part._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 64 << 20
    for name, rows in (("lines", 88), ("tickets", 30)):
        found = fixtures.bound(spark, many_parts, name)
        assert "SortMergeJoin" in _plan(found)
        assert found.count() == rows


@pytest.mark.parametrize("most", [100, 0])
def test_sides_are_sized_by_their_rows(spark, monkeypatch, most):
    monkeypatch.setattr(session, "BROADCAST_BYTES", most)
    rows = spark.createDataFrame([(1, "tea"), (None, None)], "k long, name string")
    # 4 words and a filled one, 4 words: 72 bytes.
    joined = spark.range(3).join(session.sided(rows, ["k", "name"]), F.col("id") == F.col("k"), "left")
    assert ("BroadcastHashJoin" in _plan(joined)) is (most == 100)
    assert sorted((r.id, r.name) for r in joined.collect()) == [(0, None), (1, "tea"), (2, None)]
    assert session.sided(rows.limit(0), ["k"]).count() == 0


def test_small_parts_are_sent_and_lines_are_not(spark, sf_dir):
    plan = _plan(fixtures.lines(spark, sf_dir))
    assert plan.count("BroadcastHashJoin") == 2
    assert "BuildLeft" not in plan


def test_members_in_packed_files_are_not_broadcast(spark, tmp_path):
    """Half a million names and more take several megabytes in a file, and a hundred in memory."""
    items = spark.range(1_200_000).select(
        (F.col("id") + 1).alias("item_key"), F.format_string("tea %07d", "id").alias("item_name")
    )
    items.coalesce(1).write.parquet(f"{tmp_path}/items")
    lines = spark.createDataFrame([("tea 0000007",), ("none",), (None,)], "item_name string")
    keyed = lookup_key(lines, spark.read.parquet(f"{tmp_path}/items"), "item_name", "item_key")
    assert "SortMergeJoin" in _plan(keyed)
    assert {tuple(r) for r in keyed.collect()} == {("tea 0000007", 8), ("none", None), (None, None)}


def test_blocks_of_bad_files_stay_whole(spark, sf_dir):
    """However small the pieces that tables are read in, no file begins inside a block."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = QUERIES["scan_isolate_bad_files"](spark, sf_dir)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    rows = [fixtures.table(spark, sf_dir, t).count() for t in ("lineitem", "orders")]
    counts = found.groupBy("reason", F.col("invoice_no").isNull().alias("none")).count()
    assert {(r.reason, r.none, r["count"]) for r in counts.collect()} == {
        (None, False, sum(rows)), ("row wider than the header", True, 1),
        ("unclosed quote in the header line", True, 1), ("more than 2000 columns", True, 1),
    }


def test_pruned_lines_are_merged_with_many_parts(spark, many_parts):
    """Fewer columns make the files of both sides look smaller still."""
    pruned = fixtures.lines(spark, many_parts).select("restaurant_name", "invoice_no", "item_name")
    assert "SortMergeJoin" in _plan(pruned)
    found = QUERIES["scan_isolate_bad_files"](spark, many_parts)
    assert found.where("item_name IS NOT NULL").count() == 88
    assert found.where("named_source_file IS NOT NULL").count() == 40
    assert found.where("reason IS NOT NULL").count() == 3


def test_landing_folder_of_many_parts(spark, many_parts):
    """Exported lines and tickets are merged with their parts, and all rows are found again."""
    for export in (raw.raw_lines, raw.raw_tickets):
        assert "SortMergeJoin" in _plan(export(spark, many_parts))
    found = QUERIES["scan_discover"](spark, many_parts)
    assert {(r.report, r.rows) for r in found.collect()} == {
        ("order_summary", 50), ("order_summary_item", 88), ("kot_process_time", 30),
    }
