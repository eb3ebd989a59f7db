"""Cross-model invariants of the medallion."""

from pyspark.sql import functions as F

from retail_lake.lake import Lake

from conftest import SF_MID


def test_revenue_is_conserved(spark):
    lake = Lake(spark, SF_MID)
    fct = lake.fct_sales().where("order_status NOT IN ('Cancelled')")
    silver_total = fct.selectExpr("CAST(sum(gross_revenue_inr) AS DOUBLE)").first()[0]
    gold_total = lake.sales_summary_by_product().agg(F.sum("total_revenue_inr")).first()[0]
    assert abs(silver_total - gold_total) < 1e-6 * silver_total


def test_region_split_and_shares(spark):
    r = Lake(spark, SF_MID).sales_summary_by_region()
    bad = r.where("abs(b2b_revenue + b2c_revenue - total_revenue_inr) > 1e-6").count()
    assert bad == 0
    s, n = r.agg(F.sum("revenue_share_percentage"), F.count("*")).first()
    assert abs(s - 100.0) <= 0.005 * n


def test_one_row_per_sku_keeps_every_sale(spark):
    lake = Lake(spark, SF_MID)
    staged = (lake.stg_amazon_sales.where("order_status NOT IN ('Cancelled')").count()
              + lake.stg_international_sales.where("transaction_id IS NOT NULL").count())
    assert lake.fct_sales(one_row_per_sku=True).count() == staged
    dims = lake.dim_products(one_row_per_sku=True)
    assert dims.count() == dims.select("product_sku").distinct().count()


def test_reference_variant_fans_out(spark):
    lake = Lake(spark, SF_MID)
    assert lake.fct_sales().count() > lake.fct_sales(one_row_per_sku=True).count()


def test_lazy_and_materialized_agree(spark):
    from retail_lake.params import FIXTURE_PARAMS
    lazy = Lake(spark, "/root/testdata/sf0.001", FIXTURE_PARAMS, materialize=False).sales_summary_by_region()
    mat = Lake(spark, "/root/testdata/sf0.001").sales_summary_by_region()
    assert sorted(map(tuple, lazy.collect())) == sorted(map(tuple, mat.collect()))
