"""Physical-plan properties that matter at scale."""

from retail_lake.lake import Lake
from retail_lake.params import FIXTURE_PARAMS
from retail_lake.plans import silver

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_disjoint_union_has_no_nested_loop_join(spark):
    lake = Lake(spark, SF_SMALL)
    plan = _plan(silver.dim_customers(lake.stg_amazon_sales, lake.stg_international_sales))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_region_summary_has_no_cross_join(spark):
    plan = _plan(Lake(spark, SF_SMALL).sales_summary_by_region())
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_fixture_scan_prunes_and_pushes(spark):
    lake = Lake(spark, SF_SMALL, FIXTURE_PARAMS, materialize=False)
    text = lake.raw_amazon_sales._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_linenumber), LessThanOrEqual(l_linenumber,5)" in text
    assert "l_extendedprice" not in text          # unused lineitem columns are not read


def test_dim_products_builds_no_pairs(spark):
    """The reference's many-to-many full outer join is never planned."""
    lake = Lake(spark, SF_SMALL)
    plan = _plan(silver.dim_products(lake.stg_stock_levels, lake.stg_amazon_sales,
                                     lake.stg_international_sales, FIXTURE_PARAMS.load_ts))
    assert "FullOuter" not in plan


def test_product_aggregate_has_no_expand(spark):
    """Two distinct counts in one pass: one scan of the fact, no Expand, no join of a second aggregate."""
    from retail_lake.plans import gold
    plan = _plan(gold.product_sales(Lake(spark, SF_SMALL).fct_sales()))
    assert "Expand" not in plan and "Join" not in plan and plan.count("FileScan") == 1


def test_months_are_counted_exactly(spark):
    from retail_lake.operators.aggregates import month_bits, months_set, with_month_bit
    from retail_lake.plans.gold import aggregate
    rows = [("a", d) for d in ("1970-01-01", "1970-01-31", "2069-12-31", "2001-08-01", None)] + [("b", None)] + [
        ("c", f"{y}-{m:02d}-15") for y in range(1970, 2070) for m in range(1, 13) for _ in range(2)]
    df = spark.createDataFrame(rows, "k string, t string").selectExpr("k", "CAST(t AS DATE) AS d")
    got = {r.k: r.n for r in aggregate(with_month_bit(df, "d"), ["k"], month_bits()).selectExpr("k", f"{months_set()} AS n").collect()}
    assert got == {"a": 3, "b": 0, "c": 1200}


def test_the_recent_window_reads_its_months_only(spark):
    """The fact is laid out by month: the 30-day window's plan prunes folders, and a month has few files."""
    import re

    from pyspark.sql import functions as F

    from retail_lake.plans import gold
    lake = Lake(spark, SF_SMALL)
    fact = lake.fct_sales()
    for df in (gold.recent_units(fact, lake.params.as_of), lake.inventory_analysis()):
        pruned = re.search(r"PartitionFilters: \[([^\]]*)\]", _plan(df).replace("PartitionFilters: []", ""))
        assert "order_year_month" in pruned[1] and "2001-07" in pruned[1]
    files = fact.select("order_year_month", F.col("_metadata.file_path").alias("f")).distinct()
    per_month = {r.order_year_month: r["count"] for r in files.groupBy("order_year_month").count().collect()}
    assert max(per_month.values()) <= 2 and len(per_month) > 12
    assert len([m for m in per_month if m and m >= "2001-07"]) <= 2


def test_rows_without_a_month_stay_in_the_fact(spark, tmp_path):
    from retail_lake.sources.sinks import CheckpointSink
    df = spark.createDataFrame([("a", "2001-07"), ("b", None), ("c", "2001-08"), ("d", None)],
                               "sales_id string, order_year_month string")
    back = CheckpointSink(spark, "layout-test").write("fct_sales_one_per_sku", df)
    assert back.schema == df.schema and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
