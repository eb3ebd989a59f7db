"""Randomised checks against brute force on small inputs.

The product dimension avoids the reference's many-to-many full outer join and
the customer dimension replaces a join on false with a union; both are
compared with nested loops in plain Python over random rows with NULLs,
duplicates and empty strings. The date parser is compared with plain Python.
"""

import datetime as dt
import hashlib
import random
import re

import pytest

from retail_lake.functions.cleaning import parse_dmy
from retail_lake.plans import silver
from retail_lake.schemas import STG_AMAZON_SALES, STG_INTERNATIONAL_SALES, STG_STOCK_LEVELS

TS = dt.datetime(2001, 8, 1, 6)
SKUS = ["AN001", "SET002", "JNE003", "MEN004", "J005", "BTM006", "Unknown", ""]
STYLES = ["BL1", "J2", "K3", None, ""]
SIZES = ["S", "M", "L", None]


def _rows(schema, values):
    names = [f.name for f in schema.fields]
    return [tuple(v.get(n) for n in names) for v in values]


def _random_inputs(rnd):
    stock = [dict(sku_code=rnd.choice(SKUS[:6]), design_number=rnd.choice(["d1", "d2", None]),
                  stock_quantity=rnd.randint(0, 9), category=rnd.choice(["c1", "c2"]),
                  size=rnd.choice(["S", "M", "Unknown"]), color=rnd.choice(["red", "Unknown"]),
                  loaded_timestamp=TS) for _ in range(rnd.randint(0, 8))]
    amazon = [dict(order_id=f"o{i}", sku=rnd.choice(SKUS), category=rnd.choice(["k1", "k2", None]),
                   size=rnd.choice(SIZES), order_status="Shipped", quantity=1, is_b2b=False,
                   loaded_timestamp=TS) for i in range(rnd.randint(0, 12))]
    intl = [dict(transaction_id=f"t{i}", sku=rnd.choice(SKUS), style=rnd.choice(STYLES),
                 size=rnd.choice(SIZES), customer_name=rnd.choice(["A", "B", None]), quantity=1,
                 loaded_timestamp=TS) for i in range(rnd.randint(0, 12))]
    return stock, amazon, intl


def _category(stock_sku, market_sku, style):
    rules = [(stock_sku, "AN", "Leggings"), (market_sku, "SET", "Set"), (market_sku, "JNE", "Kurta"),
             (market_sku, "MEN", "Men Kurta"), (style, "BL", "Blouse"), (style, "J", "Jacket")]
    return next((label for value, prefix, label in rules if value is not None and value.startswith(prefix)), "Other")


def _products(stock, amazon, intl):
    """Nested loops: every stock row with its channel rows, then the channel rows without stock."""
    market = {(r["sku"], r["category"], r["size"]) for r in amazon if r["sku"] != "Unknown"}
    abroad = {(r["sku"], r["style"], r["size"]) for r in intl if r["sku"] != "Unknown"}
    stocked = {r["sku_code"] for r in stock}
    out = set()
    for r in stock:
        for m in [m for m in market if m[0] == r["sku_code"]] or [(None, None, None)]:
            for x in [x for x in abroad if x[0] == r["sku_code"]] or [(None, None, None)]:
                out.add((r["sku_code"], r["design_number"], _category(r["sku_code"], m[0], x[1]), x[1], r["size"],
                         r["color"], r["category"]))
    for sku, _, size in market:
        if sku not in stocked:
            out.add((sku, None, _category(None, sku, None), None, size or "Unknown", None, None))
    for sku, style, size in abroad:
        if sku not in stocked:
            out.add((sku, None, _category(None, None, style), style, size or "Unknown", None, None))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_dim_products_equals_literal_full_outer_join(spark, seed):
    stock, amazon, intl = _random_inputs(random.Random(seed))
    s = spark.createDataFrame(_rows(STG_STOCK_LEVELS, stock), STG_STOCK_LEVELS)
    a = spark.createDataFrame(_rows(STG_AMAZON_SALES, amazon), STG_AMAZON_SALES)
    i = spark.createDataFrame(_rows(STG_INTERNATIONAL_SALES, intl), STG_INTERNATIONAL_SALES)
    got = silver.dim_products(s, a, i, TS).drop("updated_timestamp").collect()
    want = _products(stock, amazon, intl)
    key = lambda r: tuple("\x00" if x is None else str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("seed", range(3))
def test_disjoint_union_equals_join_on_false(spark, seed):
    _, amazon, intl = _random_inputs(random.Random(100 + seed))
    for r in amazon:
        r.update(ship_city=random.Random(seed).choice(["x", None]), ship_state="st", ship_country="IN")
    a = spark.createDataFrame(_rows(STG_AMAZON_SALES, amazon), STG_AMAZON_SALES)
    i = spark.createDataFrame(_rows(STG_INTERNATIONAL_SALES, intl), STG_INTERNATIONAL_SALES)
    got = silver.dim_customers(a, i).collect()
    md5 = lambda x: hashlib.md5((x or "").encode()).hexdigest()
    orders = {(r["order_id"], r["ship_city"], r["ship_state"], r["ship_country"], r["is_b2b"]) for r in amazon}
    want = [(md5(o[0]), None, *o, None) for o in orders]
    want += [(md5(n), n, None, None, None, None, None, "INTERNATIONAL") for n in {r["customer_name"] for r in intl}]
    key = lambda r: tuple("\x00" if x is None else str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def _python_dmy(text):
    if text is None:
        return None
    m = re.fullmatch(r"(\d{1,2})-(\d{1,2})-(\d{2})", text.strip(" "))
    if not m:
        return None
    d, mo, yy = (int(g) for g in m.groups())
    try:
        return dt.date((1900 if yy >= 70 else 2000) + yy, mo, d)
    except ValueError:
        return None


def test_parse_dmy_matches_python(spark):
    rnd = random.Random(5)
    parts = lambda: str(rnd.randint(0, 40)).zfill(rnd.choice([1, 2]))
    samples = [f"{parts()}-{parts()}-{str(rnd.randint(0, 99)).zfill(2)}" for _ in range(300)]
    samples += ["", " ", "1-1-1", "01/01/01", "aa-bb-cc", None, "29-02-00", "29-02-01", "31-04-99", "29-02-72",
                "29-02-96", "31-12-69", "01-01-70", "001-01-01", "1-1-001", "+1-01-01", "-1-01-01", "1-1-01 x", "1 -1-01",
                " 3-4-05 ", "1-1-2001", "0-1-01", "1-0-01", "1-1-0a"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in samples], "d string")
           .selectExpr(parse_dmy("d")).collect()]
    assert got == [_python_dmy(x) for x in samples]
