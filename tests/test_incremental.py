"""Load-by-load refresh against the full rebuild: stock windows and gold summaries."""

import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retail_lake.plans import gold
from retail_lake.plans.incremental import PRODUCT, REGION, IncrementalSummary, StockWindows, by_loads
from retail_lake.plans.silver import fct_inventory
from retail_lake.operators.windows import last_rows, moving_average
from retail_lake.plans.silver import SNAPSHOT_ORDER
from retail_lake.schemas import FCT_SALES

STOCK = ("sku_code string, stock_quantity int, category string, size string, color string, "
         "loaded_timestamp timestamp_ntz")


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(11)
    rows = []
    for day in range(5):
        for i in range(160):
            sku = "" if i % 3 == 0 else None if i % 40 == 1 else f"S{rng.randrange(60)}"
            if sku == "S7" and day in (1, 2):                # a SKU that some loads lack
                continue
            rows.append((sku, rng.randrange(60) if i % 31 else None, "x", rng.choice(["S", "M"]), f"c{i % 7}",
                         dt.datetime(2001, 7, 20 + day)))
    return spark.createDataFrame(rows, STOCK).cache()


def _load(history, day):
    return history.where(F.col("loaded_timestamp") == F.lit(dt.datetime(2001, 7, 20 + day)).cast("timestamp_ntz"))


def test_stock_loads_equal_the_full_windows(spark, history, tmp_path):
    windows = StockWindows(spark, str(tmp_path / "stock"))
    for day in range(5):
        windows.load(day, _load(history, day))
    full = moving_average(fct_inventory(history), "product_sku", SNAPSHOT_ORDER, "stock_change", "avg_weekly_stock_change", 7)
    got = windows.facts(5)
    assert got.columns == full.columns and _same(got, full)
    assert windows.tails(4).groupBy("product_sku").count().agg(F.max("count")).first()[0] == 6


def test_a_load_reads_itself_and_the_last_tails_only(spark, history, tmp_path):
    ids, rows = by_loads(history, "date_format(loaded_timestamp, 'yyyyMMdd')", "test_history")
    assert ids == [f"200107{20 + d}" for d in range(5)]
    windows = StockWindows(spark, str(tmp_path / "stock"))
    for n in range(2):
        windows.load(n, rows(ids[n]))
    plan = windows.met(2, rows(ids[2]))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*load_id", plan)
    read = windows.tails(1).inputFiles()
    assert read and all("tails/load-000001" in f for f in read)
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and not any("facts" in line for line in scans)


def test_repeated_half_done_and_late_loads(spark, history, tmp_path):
    windows = StockWindows(spark, str(tmp_path / "stock"))
    windows.load(0, _load(history, 0))
    with pytest.raises(ValueError, match="load 2 before load 1"):
        windows.load(2, _load(history, 2))
    windows.load(0, _load(history, 3))                       # committed: left out
    assert windows.facts(1).select("snapshot_date").distinct().count() == 1
    # facts written, tails not: the load is run again over its leavings
    windows.folders.write("facts", 1, windows.facts(1).limit(3))
    windows.load(1, _load(history, 1))
    full = moving_average(fct_inventory(history.where("loaded_timestamp <= timestamp_ntz'2001-07-21'")), "product_sku",
                          SNAPSHOT_ORDER, "stock_change", "avg_weekly_stock_change", 7)
    assert _same(windows.facts(2), full)
    with pytest.raises(ValueError, match="rebuild"):
        windows.load(2, _load(history, 0))                   # older than the state
    with pytest.raises(ValueError, match="no time"):
        windows.load(2, _load(history, 2).withColumn("loaded_timestamp", F.lit(None).cast("timestamp_ntz")))
    windows.load(2, history.limit(0))                        # an empty load keeps the tails
    assert _same(windows.tails(2), windows.tails(1)) and windows.facts(3).count() == windows.facts(2).count()


def test_last_rows_limits_before_the_shuffle(history):
    out = last_rows(history, "sku_code", "loaded_timestamp ASC NULLS LAST, stock_quantity, size, color, category", 2)
    assert out.groupBy("sku_code").count().agg(F.max("count")).first()[0] == 2
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.fixture(scope="module")
def fact(spark):
    rng = random.Random(3)
    rows = []
    for i in range(1500):
        hot = i % 3 == 0                                     # one group with a third of the rows
        sku = "HOT" if hot else None if i % 50 == 1 else f"S{rng.randrange(12)}"
        day = None if i % 71 == 0 else dt.date(2001, 1 + rng.randrange(12), 1 + rng.randrange(28))
        qty, inr = rng.randrange(5), Decimal(rng.randrange(10 ** 6)) / 100
        rows.append((f"o{rng.randrange(300)}" if i % 89 else None, day, rng.choice(["Shipped", "Cancelled", None]) if i % 4 == 0 else "Shipped",
                     sku, "Set", "S", None if hot else "red", qty, inr, float(inr) / qty if qty else None, "INR",
                     "City", rng.choice(["A", "B", None]), "IN", i % 2 == 0, "AMAZON", inr, inr,
                     day and day.year, day and day.month, day and f"{day:%Y-%m}"))
    return spark.createDataFrame(rows, FCT_SALES).withColumn("n", F.monotonically_increasing_id()).cache()


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@pytest.mark.parametrize("summary,full", [(PRODUCT, gold.product_sales), (REGION, gold.regional_sales)])
def test_refreshed_summaries_equal_the_rebuild(spark, fact, tmp_path, summary, full):
    state = IncrementalSummary(spark, summary, str(tmp_path / "state"))
    for load in range(4):                                    # lines of one sale meet in several loads
        state.refresh(load, fact.where(F.pmod(F.xxhash64("n"), F.lit(4)) == load).drop("n"))
        so_far = fact.where(F.pmod(F.xxhash64("n"), F.lit(4)) <= load).drop("n")
        assert _same(_rounded(state.rows(load)), _rounded(full(so_far).select(*state.rows(load).columns)))
    state.refresh(2, fact.drop("n"))                         # committed: left out
    state.refresh(4, fact.limit(0).drop("n"))                # empty: the same groups
    assert _same(state.rows(4), state.rows(3))
    pairs = spark.read.parquet(*[state.folders.path("pairs", n) for n in range(5)])
    assert pairs.count() == pairs.distinct().count()         # every pair is kept once


def test_a_small_load_does_not_shuffle_the_kept_pairs(spark, fact, tmp_path):
    state = IncrementalSummary(spark, PRODUCT, str(tmp_path / "state"))
    state.refresh(0, fact.drop("n"))
    load = state.folders.read("pairs", [0], spark.read.parquet(state.folders.path("pairs", 0)).schema).limit(5)
    plan = state.unseen(1, load)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi, BuildRight" in plan and "SortMergeJoin" not in plan
