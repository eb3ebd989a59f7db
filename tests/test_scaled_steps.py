"""Steps that must not grow faster than their input: what they sort, move and keep."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from retail_lake.lake import Lake
from retail_lake.operators.aggregates import orders_and_months
from retail_lake.plans import incremental, operator_queries, quarantine
from retail_lake.plans.dictionary import profile
from retail_lake.sources import fixtures


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_orders_and_months_are_distinct(spark):
    d = lambda y, m: dt.date(y, m, 3)
    rows = [("a", "o1", d(2001, 1), 1), ("a", "o1", d(2001, 1), 2), ("a", "o1", d(1970, 5), 4), ("a", "o2", d(2069, 12), 8),
            ("a", None, d(2001, 2), 16), ("a", "o3", None, 32), ("b", None, None, 64), (None, "o1", d(2001, 1), 128),
            (None, "", d(2001, 1), 256)]
    df = spark.createDataFrame(rows, "k string, o string, t date, v int")
    out = orders_and_months(df, ["k"], "o", "t", {"v": ("sum(v)", "sum"), "first": ("min(t)", "min")}, "orders", "months")
    assert {(r.k, r.orders, r.months, r.v, r["first"]) for r in out.collect()} == {
        ("a", 3, 4, 63, d(1970, 5)), ("b", 0, 0, 64, None), (None, 2, 1, 384, d(2001, 1))}


def test_no_group_carries_the_words_of_all_months(spark):
    lake = Lake(spark, SF_SMALL)
    plan = _plan(operator_queries.count_distinct_orders(lake))
    assert "_m18" not in plan and "row_number" in plan


def test_queries_that_read_the_fact_once_do_not_write_it(spark, monkeypatch):
    import retail_lake.lake as module
    monkeypatch.setattr(module, "_WRITTEN", {})             # as in a session of its own
    lake = Lake(spark, SF_SMALL, raw={t: getattr(fixtures, t)(spark, SF_SMALL) for t in (
        "raw_amazon_sales", "raw_international_sales", "raw_stock_levels", "raw_stock_snapshots")})
    rows = operator_queries.conditional_revenue(lake)
    assert "ship_city" not in _plan(rows)                   # columns that are not asked for are not moved
    operator_queries.left_join_recent_sales(lake).count()
    lake.sales_summary_by_product(sort=False).count()
    assert not [k for k in module._WRITTEN if k[-1].startswith("fct_sales")]
    before = {tuple(r) for r in rows.collect()}
    lake.fct_sales()
    assert {tuple(r) for r in operator_queries.conditional_revenue(lake).collect()} == before


def test_lines_meet_orders_that_know_their_customer(spark):
    """Customer and nation are joined to orders, one row each, and not to the lines."""
    plan = fixtures.raw_amazon_sales(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    at = {t: next(len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if f"{t}#" in line and "Relation" in line)
          for t in ("c_custkey", "l_orderkey", "o_orderkey")}
    assert at["o_orderkey"] > at["l_orderkey"] and at["c_custkey"] > at["l_orderkey"]


def _sorts_of_writes(spark, write) -> list[str]:
    """Plans of the inserts that ``write`` runs."""
    seen = []
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    original = type(spark.range(1).write).parquet

    def parquet(self, *args, **kwargs):
        seen.append(spark.conf.get(key))
        return original(self, *args, **kwargs)
    cls = type(spark.range(1).write)
    cls.parquet = parquet
    try:
        write()
    finally:
        cls.parquet = original
    assert spark.conf.get(key) == before
    return seen


def test_folders_are_written_without_a_sort(spark):
    landed = quarantine.as_landed("raw_stock_levels", fixtures.raw_stock_levels(spark, SF_SMALL))
    assert all(int(n) > 1 for n in _sorts_of_writes(spark, lambda: quarantine.split("raw_stock_levels", landed)))
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    assert all(int(n) > 2 for n in _sorts_of_writes(spark, lambda: incremental.by_loads(df, "CAST(g AS STRING)", "t")))


def test_dictionary_makes_no_pairs(spark):
    df = spark.createDataFrame([(1, 0.0, "x"), (2, -0.0, None), (2, None, "y"), (None, 1.5, "")], "a int, b double, c string")
    out = profile(df, "t")
    assert _plan(out).count("Generate") == 1                # the rows of the result only
    assert {(r.column_name, r.distinct_count, r.null_count) for r in out.collect()} == {("a", 2, 1), ("b", 2, 1), ("c", 3, 1)}
