"""Literal-row tests of every boundary of the cleaning and rule expressions."""

import datetime as dt

import pytest

from retail_lake.functions import cleaning as C
from retail_lake.functions import rules as R


def _eval(spark, expr, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.selectExpr(f"{expr} AS out").collect()]


def test_text_defaults(spark):
    got = _eval(spark, C.text_or_default("s"), [("  a ",), (None,), ("",), ("   ",)], "s string")
    assert got == ["a", "Unknown", "", ""]          # empty string is not NULL
    assert _eval(spark, C.text_or_default("s", "INR"), [(None,)], "s string") == ["INR"]
    assert _eval(spark, C.clean_text("s"), [("\tx ",)], "s string") == ["\tx"]   # spaces only


def test_clamps(spark):
    rows = [(-5,), (0,), (None,), (7,)]
    assert _eval(spark, C.clamp_count("q", 0), rows, "q int") == [0, 0, 0, 7]
    assert _eval(spark, C.clamp_count("q", 1), rows, "q int") == [0, 0, 1, 7]


def test_defaults_numeric_boolean(spark):
    assert _eval(spark, C.number_or_zero("a"), [(None,), (2.5,)], "a double") == [0.0, 2.5]
    assert _eval(spark, C.flag_or_false("b"), [(None,), (True,)], "b boolean") == [False, True]


@pytest.mark.parametrize("raw,expected", [
    ("01-08-01", dt.date(2001, 8, 1)),
    ("31-12-99", dt.date(1999, 12, 31)),
    ("15-06-70", dt.date(1970, 6, 15)),      # pivot: 70 -> 1970
    ("15-06-69", dt.date(2069, 6, 15)),      # 69 -> 2069
    ("05-03-02", dt.date(2002, 3, 5)),
    ("5-3-02", dt.date(2002, 3, 5)),         # one-digit day and month
    (" 01-08-01 ", dt.date(2001, 8, 1)),
    ("31-02-01", None),                      # impossible date
    ("2001-08-01", None),                    # other layout
    ("", None),
    ("garbage", None),
    (None, None),
])
def test_parse_dmy(spark, raw, expected):
    assert _eval(spark, C.parse_dmy("d"), [(raw,)], "d string") == [expected]


def test_transaction_key_null_propagates(spark):
    rows = [(" c ", "s ", "01-01-01"), (None, "s", "01-01-01")]
    got = _eval(spark, C.transaction_key("a", "b", "c"), rows, "a string, b string, c string")
    assert got == ["c_s_01-01-01", None]


def test_product_category_first_match_wins(spark):
    rows = [("AN1", "SET1", "BL1"), (None, "SET1", "BL"), (None, "JNE1", None), (None, "MEN9", None),
            (None, None, "BL3"), (None, None, "J4"), (None, "X", "K1"), (None, None, None), ("BTM1", "BTM1", "J2")]
    got = _eval(spark, R.product_category("s", "a", "i"), rows, "s string, a string, i string")
    assert got == ["Leggings", "Set", "Kurta", "Men Kurta", "Blouse", "Jacket", "Other", "Other", "Jacket"]


def test_stock_status_and_reorder(spark):
    rows = [(0,), (1,), (5,), (6,), (20,), (21,), (50,), (51,)]
    assert _eval(spark, R.stock_status("q"), rows, "q int") == [
        "Out of Stock", "Critical Stock", "Critical Stock", "Low Stock", "Low Stock", "Normal Stock",
        "Normal Stock", "Excess Stock"]
    assert _eval(spark, R.reorder_suggestion("q"), rows, "q int") == [
        "Reorder Immediately", "Reorder Immediately", "Reorder Immediately", "Reorder Soon", "Reorder Soon",
        "Stock Sufficient", "Stock Sufficient", "Stock Sufficient"]


def test_reorder_metrics(spark):
    rows = [(10, 0), (7, 30), (14, 30), (29, 30), (91, 30), (90, 30), (7, 45)]
    schema = "stock int, units bigint"
    days = _eval(spark, R.days_of_inventory("stock", "units", 30), rows, schema)
    assert days == [999.0, 7.0, 14.0, 29.0, 91.0, 90.0, 7 / (45 / 30.0)]
    actions = [r[0] for r in spark.createDataFrame([(d,) for d in days], "d double")
               .selectExpr(R.inventory_action("d")).collect()]
    assert actions == [R.ACTION_WARNING, R.ACTION_URGENT, R.ACTION_NORMAL, R.ACTION_NORMAL, R.ACTION_WARNING,
                       R.ACTION_HEALTHY, R.ACTION_CRITICAL]
    got = spark.createDataFrame([(4.0, 1.5, 3), (20.0, 1.0, 3), (13.9, 0.1, 5)], "d double, r double, s int") \
        .selectExpr(R.suggested_reorder("d", "r", "s", 30)).collect()
    assert [r[0] for r in got] == [42, 0, -2]       # ceil(45)-3, not urgent, ceil(3)-5 (may go negative)


def test_revenue_tier(spark):
    rows = [(100000.01,), (100000.0,), (50000.0,), (50000.5,), (10000.0,), (10000.5,), (None,)]
    assert _eval(spark, R.revenue_tier("v"), rows, "v double") == [
        "Premium", "High", "Medium", "High", "Low", "Medium", "Low"]


def test_to_inr_exact_decimal(spark):
    rows = [(dt.date(2001, 1, 1), "USD"), (dt.date(2001, 1, 1), "INR")]
    df = spark.createDataFrame(rows, "d date, c string").selectExpr("CAST(12.35 AS DECIMAL(18,2)) AS a", "c")
    got = [r[0] for r in df.selectExpr(f"CAST({R.to_inr('a', 'c', 83.5)} AS DECIMAL(28,6))").collect()]
    assert [str(x) for x in got] == ["1031.225000", "12.350000"]
    cent = spark.sql("SELECT CAST(0.05 AS DECIMAL(18,2)) AS a, 'USD' AS c")
    assert str(cent.selectExpr(f"CAST({R.to_inr('a', 'c', 83.1234)} AS DECIMAL(28,6))").first()[0]) == "4.156170"


def test_share_of_total_zero_total(spark):
    got = _eval(spark, R.share_of_total("p", "t"), [(1.0, 0.0), (1.0, 3.0)], "p double, t double")
    assert got == [None, 33.33]
