"""Operators that the models apply to several raw files are run over every line of all of them."""

import pytest

from conftest import SF_SMALL
from retail_lake.catalog import spark_queries


@pytest.fixture(scope="module")
def lines(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    return {"AMAZON": li.where("l_linenumber <= 5").count(), "INTERNATIONAL": li.where("l_linenumber > 5").count(),
            "STOCK": spark.read.parquet(f"{SF_SMALL}/part.parquet").count()}


@pytest.mark.parametrize("key, channels", [("clean_text_defaults", ["AMAZON", "INTERNATIONAL", "STOCK"]),
                                           ("numeric_boolean_defaults", ["AMAZON", "INTERNATIONAL"])])
def test_every_raw_row_is_cleaned(spark, lines, key, channels):
    got = {r["channel"]: r["count"] for r in spark_queries()[key](spark, SF_SMALL).groupBy("channel").count().collect()}
    assert got == {c: lines[c] for c in channels} and all(got.values())


def test_both_channels_lose_unknown_skus_only(spark):
    queries = spark_queries()
    kept = queries["drop_unknown_sku"](spark, SF_SMALL)
    for channel, model in (("AMAZON", "stg_amazon_sales"), ("INTERNATIONAL", "stg_international_sales")):
        staged = queries[model](spark, SF_SMALL).where("sku != 'Unknown'")
        of_channel = kept.where(f"channel = '{channel}'")
        assert of_channel.count() == staged.count() > 0
        own = ["sku", "style" if channel == "INTERNATIONAL" else "category", "size"]
        distinct = queries["distinct_sku_attributes"](spark, SF_SMALL).where(f"channel = '{channel}'").select(*own)
        assert sorted(map(str, distinct.collect())) == sorted(map(str, staged.select(*own).distinct().collect()))
