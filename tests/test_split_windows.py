"""Windows over ranges of a key's order against the plain window, with a SKU of a third of the rows."""

import datetime as dt
import random

import pytest

from retail_lake.operators.windows import lag_delta, moving_average, padded_ranges
from retail_lake.plans.silver import SNAPSHOT_ORDER

SCHEMA = ("product_sku string, snapshot_date timestamp_ntz, stock_quantity int, size string, color string, "
          "category string")


@pytest.fixture(scope="module")
def snaps(spark):
    rng = random.Random(5)
    rows = []
    for i in range(6000):
        sku = "" if i % 3 == 0 else None if i % 50 == 1 else f"S{rng.randrange(400)}"
        rows.append((sku, dt.datetime(2001, 7, 20 + rng.randrange(8)) if i % 97 else None,
                     None if i % 89 == 0 else rng.randrange(60), rng.choice(["S", "M", None]), f"c{i}", "x"))
    return spark.createDataFrame(rows, SCHEMA).cache()


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("rows_a_task", [40, 500, 10 ** 6])
def test_split_windows_equal_plain_windows(snaps, rows_a_task):
    plain = snaps.selectExpr("*", f"lag(stock_quantity) OVER (PARTITION BY product_sku ORDER BY {SNAPSHOT_ORDER}) AS prev",
                             f"stock_quantity - lag(stock_quantity) OVER (PARTITION BY product_sku ORDER BY {SNAPSHOT_ORDER})"
                             " AS delta")
    assert _same(lag_delta(snaps, "product_sku", SNAPSHOT_ORDER, "stock_quantity", "prev", "delta", rows_a_task), plain)
    plain = snaps.selectExpr("*", f"avg(stock_quantity) OVER (PARTITION BY product_sku ORDER BY {SNAPSHOT_ORDER} "
                                  "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m")
    assert _same(moving_average(snaps, "product_sku", SNAPSHOT_ORDER, "stock_quantity", "m", 7, rows_a_task), plain)


def test_a_hot_key_is_dealt_to_many_ranges(snaps):
    padded = padded_ranges(snaps, "product_sku", SNAPSHOT_ORDER, 6, 40)
    sizes = sorted(r["count"] for r in padded.groupBy("__range").count().collect())
    assert len(sizes) > 30 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
    groups = [r["count"] for r in padded.groupBy("__range", "product_sku").count().collect()]
    assert max(groups) <= 3 * sizes[len(sizes) // 2]          # what one window task sorts
    assert padded.where("__pad").count() <= 6 * 40
    assert padded.where("__pad and product_sku = ''").select("__range").distinct().count() >= 10


def test_empty_and_single_rows(spark, snaps):
    empty = snaps.limit(0)
    assert lag_delta(empty, "product_sku", SNAPSHOT_ORDER, "stock_quantity", "p", "d").count() == 0
    one = moving_average(snaps.limit(1), "product_sku", SNAPSHOT_ORDER, "stock_quantity", "m", 7)
    assert one.count() == 1
