"""Quarantine of landed text: reasons, the split, and the columns of a file."""

import pytest

from retail_lake.lake import Lake
from retail_lake.plans import bronze
from retail_lake.plans.quarantine import REQUIRED, as_landed, column_checks, judged, rejected, split
from retail_lake.params import FIXTURE_LOAD_TS
from retail_lake.schemas import RAW_SCHEMAS

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def stock(spark):
    text = ", ".join(f"`{f.name}` string" for f in RAW_SCHEMAS["raw_stock_levels"].fields)
    return spark.createDataFrame([
        (" A1 ", "d", "5", "c", "S", "red"), (None, "d", "7", "c", "S", "red"), ("A2", "d", "many", "c", None, "red"),
        (None, None, "1.5x", None, None, None), ("A3", None, None, None, None, None), ("", "d", " 8 ", "c", "S", "x"),
        ("A2", "d", "many", "c", None, "red")], text)


def test_reasons(stock):
    got = [tuple(r) for r in judged("raw_stock_levels", stock).select("SKU Code", "Stock", "quarantine_reasons").collect()]
    assert [r[2] for r in got] == [[], ["SKU Code: missing"], ["Stock: not int"], ["SKU Code: missing", "Stock: not int"],
                                   [], [], ["Stock: not int"]]


def test_staged_and_quarantined_are_the_file(stock):
    staged, out = split("raw_stock_levels", stock)
    assert staged.schema == RAW_SCHEMAS["raw_stock_levels"]
    assert sorted((r["SKU Code"], r["Stock"]) for r in staged.collect()) == [("", 8), (" A1 ", 5), ("A3", None)]
    assert out.count() == 4 and staged.count() + out.count() == stock.count()
    assert out.drop("quarantine_reasons").exceptAll(stock).isEmpty()         # landed text, repeated rows kept
    payloads = {r.payload: r.reasons for r in rejected("raw_stock_levels", out).collect()}
    assert payloads["||1.5x|||"] == "SKU Code: missing; Stock: not int"
    for side in (staged, out):
        assert "PartitionFilters: [isnotnull(quarantined" in side._jdf.queryExecution().executedPlan().toString()


def test_dates_and_empty_files(spark):
    names = [f.name for f in RAW_SCHEMAS["raw_international_sales"].fields]
    row = dict.fromkeys(names, "1") | {"SKU": "s"}
    days = ["31-02-01", "5-6-01", None, "yesterday"]
    landed = spark.createDataFrame([tuple((row | {"DATE": d})[n] for n in names) for d in days],
                                   ", ".join(f"`{n}` string" for n in names))
    got = {r["DATE"]: r.quarantine_reasons for r in judged("raw_international_sales", landed).collect()}
    bad = ["DATE: not date (DD-MM-YY)"]
    assert got == {"31-02-01": bad, "5-6-01": [], None: [], "yesterday": bad}
    staged, out = split("raw_international_sales", landed.limit(0))
    assert staged.count() == out.count() == 0


def test_columns_of_a_file(stock):
    got = {r.column_name: (r.checked_rows, r.present, r.malformed, r.status) for r in
           column_checks("raw_stock_levels", stock.drop("Color")).collect()}
    assert got["Stock"] == (7, 6, 3, "failed") and got["SKU Code"] == (7, 5, 0, "passed")
    assert got["Color"] == (7, 0, 0, "missing")


@pytest.mark.parametrize("table", REQUIRED)
def test_bronze_of_staged_rows_is_bronze_of_the_file(spark, table):
    raw = getattr(Lake(spark, SF_SMALL), table)
    model = getattr(bronze, table.replace("raw_", "stg_"))
    staged, out = split(table, as_landed(table, raw))
    assert out.count() > 0
    a, b = model(staged, FIXTURE_LOAD_TS), model(raw, FIXTURE_LOAD_TS)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
