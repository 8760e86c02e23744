"""Column expressions on single values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillmart.functions import numbers, orders, text
from tillmart.operators.enrich import enrich_orders, parse_sub_order_type


def value(spark, expression, **columns):
    df = spark.range(1).withColumns({k: F.lit(v) for k, v in columns.items()})
    return df.select(expression.alias("v")).first().v


@pytest.mark.parametrize(
    "raw, brand, platform",
    [
        ("Thepla House By Tejals - Zomato", "Thepla House By Tejals", "Zomato"),
        ("Homely & Healthy App - Swiggy (Toing)", "Homely & Healthy App", "Swiggy (Toing)"),
        ("Dine In", None, "Dine In"),
        ("A - B - C", "A - B", "C"),
        ("A - - B", "A -", "B"),
        ("  ", None, None),
        (None, None, None),
        ("\t X - Swiggy\n(Toing) ", "X", "Swiggy\n(Toing)"),
        (" - Zomato", None, "- Zomato"),
        ("é - ü - ö", "é - ü", "ö"),
    ],
)
def test_parse_sub_order_type(spark, raw, brand, platform):
    df = spark.createDataFrame([(raw,)], "raw string")
    row = parse_sub_order_type(df, "raw").first()
    assert (row.brand, row.platform) == (brand, platform)


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("homely  AND healthy", "Homely & Healthy"),
        ("Thepla House", "Thepla House By Tejals"),
        ("HOMELY HEALTHY", "Homely & Healthy"),
        ("Bandra", "Bandra"),
        ("New", "New"),
        (None, None),
    ],
)
def test_standard_brand(spark, raw, expected):
    brand = F.lit(raw).cast("string")
    assert value(spark, orders.standard_brand(brand)) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("SWIGGY (Toing)", "Swiggy"),
        ("zomato", "Zomato"),
        ("Swiggy\n(Toing)", "Swiggy\n(Toing)"),
        ("pick  up", "pick  up"),
        (None, None),
    ],
)
def test_standard_platform(spark, raw, expected):
    assert value(spark, orders.standard_platform(F.lit(raw).cast("string"))) == expected


@pytest.mark.parametrize(
    "clock, expected",
    [
        ("04:59:00", "Late Night"), ("04:59:01", None), ("05:00:00", "Breakfast"),
        ("10:59:00", "Breakfast"), ("10:59:30", None), ("11:00:00", "Lunch"),
        ("15:59:00", "Lunch"), ("15:59:00.000001", None), ("18:59:00", "Snacks"),
        ("22:59:00", "Dinner"), ("22:59:00.5", None), ("23:00:00", "Late Night"),
        ("23:59:59.9", "Late Night"), ("00:00:00", "Late Night"), (None, None),
    ],
)
def test_daypart(spark, clock, expected):
    stamp = F.lit(clock and f"2026-05-01 {clock}").cast("timestamp_ntz")
    assert value(spark, orders.daypart(stamp)) == expected


def test_calendar(spark):
    stamp = F.lit("2026-05-01 20:15:00").cast("timestamp_ntz")
    row = spark.range(1).select(*[c.alias(n) for n, c in orders.calendar(stamp).items()]).first()
    assert tuple(row) == (dt.date(2026, 5, 1), "Friday", 5, "May", 2, 2026)
    nothing = F.lit(None).cast("timestamp_ntz")
    row = spark.range(1).select(*[c.alias(n) for n, c in orders.calendar(nothing).items()]).first()
    assert set(row) == {None}


@pytest.mark.parametrize(
    "brand, platform, day, part, expected",
    [
        (None, "Zomato", "2026-05-01", "Lunch", ["Platform exists without brand"]),
        (None, "Dine In", "2026-05-01", "Lunch", []),
        ("X", "Zomato", None, None, ["Unknown brand", "Missing business date", "Missing daypart"]),
        ("Homely & Healthy", None, "2026-05-01", "Lunch", ["Brand exists without platform"]),
        (None, "Dunzo", "2026-05-01", "Lunch", ["Unknown platform", "Platform exists without brand"]),
        (None, None, "2026-05-01", "Lunch", []),
    ],
)
def test_validation(spark, brand, platform, day, part, expected):
    errors = orders.validation_errors(
        F.lit(brand).cast("string"), F.lit(platform).cast("string"),
        F.lit(day).cast("date"), F.lit(part).cast("string"),
    )
    assert value(spark, errors) == expected


def test_enrich_without_sub_order_type(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 5, 1, 12),)], "at timestamp_ntz")
    row = enrich_orders(df, timestamp_column="at").first()
    assert (row.brand, row.platform, row.daypart) == (None, None, "Lunch")


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Preparation Time Taken (Mins)", "preparation_time_taken_mins"),
        (" Discount % ", "discount"),
        ("A / B", "a_b"),
        ("SAP\nCode", "sap\ncode"),
        ("__x__y", "x_y"),
    ],
)
def test_column_name(raw, expected):
    assert text.column_name(raw) == expected


@pytest.mark.parametrize("blank", list(text.BLANKS))
def test_strip_knows_every_blank(spark, blank):
    assert value(spark, text.strip(F.lit(f"{blank}a b{blank}"))) == "a b"


def test_strip_leaves_empty_text(spark):
    assert value(spark, text.strip(F.lit(" "))) == ""
    assert value(spark, text.blank_to_null(F.lit(" \t"))) is None


@pytest.mark.parametrize("raw", ["", "-", "--", "NA", "N/A", "NULL", "null", "None", "none", "NaN", "nan"])
def test_null_tokens(spark, raw):
    assert value(spark, text.null_tokens(F.lit(raw))) is None


@pytest.mark.parametrize("raw", ["n/a", "Na", "x", "0"])
def test_other_texts_stay(spark, raw):
    assert value(spark, text.null_tokens(F.lit(raw))) == raw


def test_safe_ratio(spark):
    assert value(spark, numbers.safe_ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, numbers.safe_ratio(F.lit(2.01), F.lit(2))) == 1.01
    assert value(spark, numbers.safe_ratio(F.lit(None).cast("double"), F.lit(2))) is None


@pytest.mark.parametrize(
    "minutes, expected",
    [(9.99, "Excellent"), (10.0, "Good"), (15.0, "Needs Attention"), (None, "Needs Attention")],
)
def test_performance(spark, minutes, expected):
    assert value(spark, orders.performance(F.lit(minutes).cast("double"))) == expected


@pytest.mark.parametrize(
    "status, reason, expected",
    [
        ("Success", "x", "Not Cancelled"), ("Cancelled", None, "Unknown"),
        ("Cancelled", "Late", "Late"), (None, None, "Unknown"),
    ],
)
def test_cancel_reason(spark, status, reason, expected):
    column = orders.cancel_reason(F.lit(status).cast("string"), F.lit(reason).cast("string"))
    assert value(spark, column) == expected
