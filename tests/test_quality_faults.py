"""Checks see the faults that they are named for."""

import dataclasses
import datetime as dt

from conftest import SF_SMALL
from retail_lake.lake import Lake
from retail_lake.params import FIXTURE_PARAMS
from retail_lake.plans import quality


def _status(lake, checks):
    return {(r.table_name, r.check_name): r.status for r in quality.run_checks(lake, checks).collect()}


def _lake(spark, **tables):
    """A Lake of its own (raw tables given) in which some tables are replaced by faulty ones."""
    good = Lake(spark, SF_SMALL)
    raw = {t: getattr(good, t) for t in ("raw_amazon_sales", "raw_international_sales", "raw_stock_levels")}
    lake = Lake(spark, SF_SMALL, raw=raw)
    for name, build in tables.items():
        lake.provide(name, build(good))
    return lake


def test_lost_rows_are_not_accounted_for(spark):
    lake = _lake(spark, stg_amazon_sales=lambda g: g.stg_amazon_sales.where("quantity <> 3"),
                 stg_stock_levels=lambda g: g.stg_stock_levels.union(g.stg_stock_levels))
    got = _status(lake, quality.row_count_checks())
    assert got["stg_amazon_sales", "rows_accounted_for"] == got["stg_stock_levels", "rows_accounted_for"] == "failed"
    assert got["stg_international_sales", "rows_accounted_for"] == "passed"


def test_stale_loads_and_sales(spark):
    late = dataclasses.replace(FIXTURE_PARAMS, as_of=dt.date(2026, 1, 1))
    got = _status(Lake(spark, SF_SMALL, late), quality.freshness_checks())
    assert set(got.values()) == {"failed", "warning"}
    assert set(_status(Lake(spark, SF_SMALL), quality.freshness_checks()).values()) == {"passed"}


def test_corrupt_gold_tables_fail(spark):
    lake = _lake(spark, sales_summary_by_region=lambda g: g.sales_summary_by_region(sort=False).where("state_rank > 1"),
                 sales_summary_by_product=lambda g: g.sales_summary_by_product(sort=False).where("revenue_rank > 1"))
    got = _status(lake, quality.metric_checks() + quality.completeness_checks())
    assert set(got.values()) == {"failed"}


def _shuffle_files(spark) -> int:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_completeness_writes_no_fact_and_leaves_no_shuffles(spark, monkeypatch):
    """Group keys need neither the written fact nor the shuffle files of the writes before."""
    raw = {"raw_amazon_sales": [("o1", "01-08-01", "Shipped", "AN1", 2, "Delhi"), ("o2", "02-08-01", "Cancelled", "AN1", 1, "Goa"),
                                ("o3", "03-08-01", "Shipped", None, 1, None), ("o3", "03-08-01", None, "AN2", 1, "Goa")],
           "raw_international_sales": [("c1", "AN2 ", "04-08-01", 3), (None, "XX", "05-08-01", 1)],
           "raw_stock_levels": [("AN1", "red"), ("AN1", "blue"), ("AN2", None)]}
    good = Lake(spark, SF_SMALL)
    names = {"raw_amazon_sales": ["Order ID", "Date", "Status", "SKU", "Qty", "ship-state"],
             "raw_international_sales": ["CUSTOMER", "SKU", "DATE", "PCS"], "raw_stock_levels": ["SKU Code", "Color"]}
    frames = {}
    for t, rows in raw.items():
        schema = getattr(good, t).schema
        full = [tuple(dict(zip(names[t], r)).get(f.name) for f in schema) for r in rows]
        frames[t] = spark.createDataFrame(full, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema))
    lake, written, left = Lake(spark, SF_SMALL, raw=frames), [], []
    write, staged = lake.sink.write, quality.gold.stage
    monkeypatch.setattr(lake.sink, "write", lambda name, df: written.append(name) or write(name, df))

    def counted(df, label):
        before = _shuffle_files(spark)
        out = staged(df, label)
        left.append(_shuffle_files(spark) - before)
        return out
    monkeypatch.setattr(quality.gold, "stage", counted)
    results = quality.run_checks(lake, quality.completeness_checks())
    got = {r.table_name: (r.status, r.violations, r.checked_rows) for r in results.collect()}
    # AN1 in two colours and an unknown SKU on the marketplace, AN2 on both channels (a sale without customer has no id); two states
    assert got == {"sales_summary_by_product": ("passed", 0, 5), "sales_summary_by_region": ("passed", 0, 2)}
    assert "fct_sales" not in written and "dim_products" in written
    assert len(left) == 2 and max(left) <= 0
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") != "true"


def test_checks_of_a_table_share_one_scan(spark):
    lake = Lake(spark, SF_SMALL)
    checks = [c for c in quality.null_checks() + quality.business_rule_checks() + quality.freshness_checks()
              if c.table == "stg_amazon_sales"]
    assert len(checks) >= 6
    lake.stg_amazon_sales
    plan = quality.run_checks(lake, checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_malformed_seed_values_are_recorded(spark, tmp_path):
    from retail_lake.sources.seeds import malformed_values
    f = tmp_path / "stock.csv"
    f.write_text("SKU Code,Design No.,Stock,Category,Size,Color\nSKU1,D,twelve,C,S,Red\nSKU2,D,,C,S,Red\nSKU3,D,4,C,S,Red\n")
    got = quality.seed_value_results(malformed_values(spark, "raw_stock_levels", str(f))).collect()
    assert [tuple(r) for r in got] == [("bronze", "raw_stock_levels", "castable:Stock", "warning", 1, 2)]


def test_staged_folders_leave_with_their_block(spark):
    import os

    from retail_lake.operators.stages import stage, staged_for_block
    with staged_for_block(spark):
        inside = stage(spark.range(3), "inside")
        (path,) = {os.path.dirname(p) for p in inside.inputFiles()}
        assert inside.count() == 3
    assert not os.path.exists(path.removeprefix("file://"))
    assert stage(spark.range(3), "outside").count() == 3
