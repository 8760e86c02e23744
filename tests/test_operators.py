"""Operators on small frames, against brute force where that is easy."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tillmart.operators import cleanse, infer, profile, quality, reconcile
from tillmart.operators.lookup import attach_order_context, lookup_key
from tillmart.operators.numbering import number_in_order, running_total
from tillmart.operators.silver import silver_pipeline
from tillmart.plans.gold import build_dimension, build_gold_layer, project


def types(spark, *values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    chosen = infer.infer_types(df)
    out = infer.convert_columns(df, chosen)
    return out.schema["c"].dataType.simpleString(), [r.c for r in out.collect()]


@pytest.mark.parametrize(
    "values, kind, first",
    [
        (("1", "2", None), "bigint", 1),
        (("1", "2.5"), "double", 1.0),
        (("1.0", "2e2"), "bigint", 1),
        (("123456789012345678", "1"), "bigint", 123456789012345678),
        (("y", "No", "TRUE"), "boolean", True),
        (("1", "0"), "bigint", 1),
        (("1", "x"), "string", "1"),
        ((None, None), "string", None),
        (("1d", "2"), "string", "1d"),
        (("2026", "2025"), "bigint", 2026),
        (("2026-05-01 10:11:12", "2026-05-02"), "timestamp_ntz", dt.datetime(2026, 5, 1, 10, 11, 12)),
        (("2026-05-01T10:11:12.5", "2026-05-02T00:00"), "timestamp_ntz", dt.datetime(2026, 5, 1, 10, 11, 12, 500000)),
        (("05/06/2026", "07/08/2026"), "timestamp_ntz", dt.datetime(2026, 5, 6)),
        (("05/06/2026", "25/06/2026"), "timestamp_ntz", dt.datetime(2026, 6, 5)),
        (("2026-05-01", "2026-13-01"), "string", "2026-05-01"),
        (("2026-05-01", "7"), "string", "2026-05-01"),
    ],
)
def test_inference(spark, values, kind, first):
    got, rows = types(spark, *values)
    assert got == kind
    assert rows[0] == first


def test_inference_skips_typed_columns(spark):
    df = spark.createDataFrame([(1, "1")], "a int, b string")
    assert infer.infer_types(df) == {"b": "bigint"}


def test_colliding_names_are_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "`A B` int, `a_b` int")
    with pytest.raises(ValueError, match="a_b"):
        cleanse.standardize_columns(df)


def test_duplicates_are_removed_per_file(spark):
    df = spark.createDataFrame(
        [(1, None, "f"), (1, None, "f"), (1, None, "g"), (2, "x", "g")],
        "a int, b string, source_file string",
    )
    assert cleanse.remove_duplicates(df).count() == 3


def test_union_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3,)], "x int")
    rows = {tuple(r) for r in cleanse.union_files([a, b]).collect()}
    assert rows == {(1, 2), (3, None)}


def test_silver_pipeline(spark):
    df = spark.createDataFrame(
        [(" 1 ", "N/A", "f"), ("1", " -", "f"), ("2", "x", "f"), ("-3", "y", "g")],
        "`Bill No` string, `Note (x)` string, source_file string",
    )
    result = silver_pipeline(df)
    assert result.types == {"bill_no": "bigint"}
    assert {tuple(r) for r in result.rows.collect()} == {
        (1, None, "f"), (2, "x", "f"), (-3, "y", "g"),
    }
    metrics = {r.source_file: (r.rows_before, r.rows_after, r.duplicates_removed)
               for r in result.metrics.collect()}
    assert metrics == {"f": (3, 2, 1), "g": (1, 1, 0)}
    found = {(r.source_file, r.rule, r.n) for r in result.findings.collect()}
    assert found == {("f", "duplicate_ids", 2), ("g", "negative_values", 1)}


def test_quality_messages(spark):
    df = spark.createDataFrame(
        [(1, -1.0, dt.datetime(1800, 1, 1)), (1, 2.0, dt.datetime(2999, 1, 1)),
         (2, None, None), (None, 3.0, dt.datetime(2020, 1, 1))],
        "order_id int, amount double, at timestamp_ntz",
    )
    messages = {r.message for r in quality.quality_report(df).collect()}
    assert messages == {
        "Column 'amount' contains 1 negative value(s).",
        "Column 'order_id' has 2 duplicate identifier candidate value(s).",
        "Column 'order_id' has 1 null identifier value(s).",
        "Column 'at' contains 2 impossible date value(s) (before 1900-01-01 or in the future).",
    }


def test_quality_without_matching_columns(spark):
    df = spark.createDataFrame([("a",)], "note string")
    assert quality.quality_report(df).count() == 0


def test_numbering(spark):
    words = [f"w{random.Random(i).randrange(10**6):06d}" for i in range(500)] + [None]
    df = spark.createDataFrame([(w,) for w in sorted(set(words), key=str)], "w string").repartition(5)
    numbered = number_in_order(df, order_by=["w"], output="k")
    rows = {r.w: r.k for r in numbered.collect()}
    ordered = sorted(w for w in rows if w is not None) + [None]
    assert rows == {w: i + 1 for i, w in enumerate(ordered)}
    assert numbered.columns == ["k", "w"]


def test_running_total_within_groups(spark):
    rows = [(g, v, v % 7 + 1) for g in "ab" for v in range(200)]
    df = spark.createDataFrame(rows, "g string, v int, n int")
    got = running_total(
        df, within=["g"], order_by=["v"], weight=F.col("n"), output="upto", runs=6
    )
    seen = {(r.g, r.v): r.upto for r in got.collect()}
    for g in "ab":
        upto = 0
        for v in range(200):
            upto += v % 7 + 1
            assert seen[g, v] == upto


def test_running_total_spreads_one_group(spark):
    df = spark.range(10_000).select(F.lit("hot").alias("g"), F.col("id").alias("v"))
    total = running_total(
        df, within=["g"], order_by=["v"], weight=F.lit(1), output="upto", runs=8
    )
    assert total.agg(F.max("upto")).first()[0] == 10_000
    runs = total.select(F.spark_partition_id().alias("p")).distinct().count()
    assert runs >= 1


@pytest.mark.parametrize("n", [1, 2, 7, 100, 101])
def test_median_is_exact(spark, n):
    rng = random.Random(n)
    values = [rng.choice([-1.5, 0.0, 2.25, 1e6, rng.random()]) for _ in range(n)]
    df = spark.createDataFrame([(v, None) for v in values], "x double, y double")
    rows = profile.profile_numeric(df).collect()
    assert [r.column_name for r in rows] == ["x"]
    row = rows[0]
    assert row.median == pytest.approx(round(statistics.median(values), 4), abs=1e-4)
    assert row.mean == pytest.approx(round(statistics.fmean(values), 4), abs=1e-4)
    assert (row.min, row.max) == (min(values), max(values))
    assert row.negative_values == sum(v < 0 for v in values)
    assert row.zero_values == sum(v == 0 for v in values)


def test_profile_of_empty_frame(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert profile.profile_columns(df).count() == 0
    assert tuple(profile.profile_duplicates(df).first()) == (0, 0, 0.0)


def test_lookup_skips_absent_column_and_keeps_rows(spark):
    df = spark.createDataFrame([("a",), (None,), ("z",)], "brand string")
    dim = spark.createDataFrame([(1, "a"), (2, None)], "brand_key int, brand string")
    assert lookup_key(df, dim, "item_name", "item_key") is df
    plain = {(r.brand, r.brand_key) for r in lookup_key(df, dim, "brand", "brand_key").collect()}
    assert plain == {("a", 1), (None, None), ("z", None)}
    safe = lookup_key(df, dim, "brand", "brand_key", null_safe=True)
    assert (None, 2) in {(r.brand, r.brand_key) for r in safe.collect()}


def test_order_context_fans_out(spark):
    lines = spark.createDataFrame(
        [("r", 1, 5.0), ("r", 2, 6.0), ("r", None, 7.0)],
        "restaurant_name string, invoice_no int, item_total double",
    )
    headers = spark.createDataFrame(
        [("r", "1", None, "b", "p"), ("r", "1", None, "c", "p"), ("r", None, None, "n", "p")],
        "restaurant_name string, invoice_no string, business_date date, brand string, platform string",
    )
    got = sorted(
        (r.invoice_no or "", r.brand or "") for r in attach_order_context(lines, headers).collect()
    )
    assert got == [("", "n"), ("1", "b"), ("1", "c"), ("2", "")]


def test_hot_order_key_is_split(spark):
    """A third of all lines on one order: adaptive execution splits that partition."""
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
        lines = spark.range(0, 60_000, 1, 8).select(
            F.lit("r").alias("restaurant_name"), hot.cast("string").alias("invoice_no"),
            F.sha2(F.col("id").cast("string"), 256).alias("item_name"),
        )
        headers = spark.range(0, 60_000, 1, 8).select(
            F.lit("r").alias("restaurant_name"), F.col("id").cast("string").alias("invoice_no"),
            F.current_date().alias("business_date"), F.lit("b").alias("brand"),
            F.lit("p").alias("platform"),
        )
        joined = attach_order_context(lines, headers)
        assert joined.filter("brand = 'b'").count() == 60_000
        rows = joined.collect()
        assert len(rows) == 60_000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_header_keys_are_cut_into_rectangles(spark):
    """A third of the headers and many lines on one key, NULLs on another; same rows as a join."""
    lines = spark.range(0, 3000).select(
        F.when(F.col("id") % 10 > 0, F.lit("r")).alias("restaurant_name"),
        F.when(F.col("id") % 10 > 0, F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("invoice_no"),
        F.col("id").cast("string").alias("item_name"),
    )
    headers = spark.range(0, 900).select(
        F.when(F.col("id") % 10 > 1, F.lit("r")).alias("restaurant_name"),
        F.when(F.col("id") % 10 > 1, F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("invoice_no"),
        F.current_date().alias("business_date"), F.col("id").cast("string").alias("brand"),
        F.lit("p").alias("platform"),
    )
    confs = {
        "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        plain = attach_order_context(lines, headers, worth=10**9)
        cut = attach_order_context(lines, headers, worth=1)
        rows = [sorted(map(str, df.collect())) for df in (plain, cut)]
        assert rows[0] == rows[1] and len(rows[0]) > 200_000
        sizes = [r["count"] for r in cut.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 3 * sum(sizes) / 16
        whole = [r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()]
        assert max(whole) > 8 * sum(whole) / 16
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_samples_of_failing_lookups(spark):
    keyed = spark.range(1000).select(
        "id", F.lit("b").alias("brand"), F.when(F.col("id") % 2 == 0, 1).alias("brand_key"),
        F.concat(F.lit("i"), "id").alias("item_name"), F.when(F.col("id") > 2, 7).alias("item_key"),
    )
    rows = [
        sorted(map(tuple, reconcile.failing_samples(keyed.repartition(n), "f", 5).collect())) for n in (1, 7)
    ]
    assert rows[0] == rows[1] and len(rows[0]) == 8
    assert {(r[1], r[2]) for r in rows[0] if r[1] == "item_key"} == {("item_key", f"i{i}") for i in range(3)}
    assert all('"brand":"b"' in r[3] for r in rows[0])


def test_project_fails_on_missing_column(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="b"):
        project(df, {"a": "int", "b": "int"})


def orders_frame(spark):
    from tillmart.plans.gold import ORDER_MEASURES

    base = spark.createDataFrame(
        [("r2", "1", None, "B - Zomato"), ("r1", "1", dt.datetime(2026, 5, 1, 12), "Dine In"),
         ("r1", "2", dt.datetime(2026, 5, 2, 23), "B - Zomato")],
        "restaurant_name string, invoice_no string, date timestamp_ntz, sub_order_type string",
    )
    from tillmart.operators.enrich import enrich_orders

    filled = base.withColumns(
        {c: F.lit("x") for c in ("kot_no", "order_type", "status", "order_cancel_reason")}
        | {c: F.lit(1.5) for c in ORDER_MEASURES}
    )
    return enrich_orders(filled, timestamp_column="date", sub_order_type_column="sub_order_type")


def test_gold_layer(spark):
    orders = orders_frame(spark)
    items = spark.createDataFrame(
        [("r1", 1, "tea", "drinks"), ("r1", 9, "tea", None), ("r2", 1, "bun", "food")],
        "restaurant_name string, invoice_no int, item_name string, category_name string",
    ).withColumns({c: F.lit(2.0) for c in ("item_quantity", "item_price", "item_total")})
    tickets = spark.createDataFrame(
        [(1, dt.datetime(2026, 5, 1, 9), "tea"), (2, dt.datetime(2020, 1, 1), "pie")],
        "kot_id int, punch_time timestamp_ntz, item_name string",
    ).withColumns(
        {c: F.lit("s") for c in ("order_type", "server_name", "item_status")}
        | {c: F.lit(3.0) for c in ("qty", "price", "preparation_time_taken_mins")}
    )
    gold = build_gold_layer(orders, items, tickets)
    dates = [(r.date_key, r.business_date) for r in gold.dimensions["date"].orderBy("date_key").collect()]
    assert dates == [(1, dt.date(2026, 5, 1)), (2, dt.date(2026, 5, 2)), (3, None)]
    brands = [r.brand for r in gold.dimensions["brand"].collect()]
    assert brands == ["B"]
    facts = {(r.restaurant_key, r.invoice_no): (r.date_key, r.brand_key)
             for r in gold.facts["orders"].collect()}
    assert facts == {(2, "1"): (3, 1), (1, "1"): (1, None), (1, "2"): (2, 1)}
    # A line without a header has no date, and no date is a member of the calendar.
    lines = {(r.restaurant_key, r.invoice_no): (r.date_key, r.category_key, r.item_key)
             for r in gold.facts["order_items"].collect()}
    assert lines == {(1, "1"): (1, 1, 2), (1, "9"): (3, None, 2), (2, "1"): (3, 2, 1)}
    kitchen = {r.kot_id: (r.date_key, r.item_key) for r in gold.facts["kitchen"].collect()}
    assert kitchen == {1: (1, 2), 2: (None, None)}
    checks = reconcile.row_counts(gold.facts, {"orders": orders, "order_items": items, "kitchen": tickets})
    assert all(r.matches for r in checks.collect())


def test_dimension_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "brand string")
    assert build_dimension(df, "brand").count() == 0


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000)
    a = reconcile.seeded_sample(df.repartition(3), 20, 42, ["id"]).collect()
    b = reconcile.seeded_sample(df.repartition(7), 20, 42, ["id"]).collect()
    assert a == b and len(a) == 20


class FakeSession:
    """Just enough of a session to ask where scratch tables go."""

    def __init__(self, master, folder=None, conf=None):
        self.sparkContext = self
        self.master, self.folder, self.conf_value = master, folder, conf

    def getConf(self):
        return {"spark.checkpoint.dir": self.conf_value} if self.conf_value else {}

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_scratch_folder():
    from tillmart.session import scratch_root

    assert scratch_root(FakeSession("spark://x", conf="/shared")) == "/shared"
    assert scratch_root(FakeSession("spark://x", folder="/set")) == "/set"
    local = FakeSession("local[2]")
    assert scratch_root(local) == local.folder != None  # noqa: E711
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(FakeSession("spark://x"))
