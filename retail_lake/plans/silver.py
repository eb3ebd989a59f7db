"""Silver layer: customer and product dimensions, inventory and sales facts (M4-M7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.functions.cleaning import UNKNOWN
from retail_lake.functions.rules import (
    product_category, reorder_suggestion, safe_ratio, stock_status, to_inr,
)
from retail_lake.operators.setops import disjoint_outer_union, union_all
from retail_lake.operators.windows import lag_delta
from retail_lake.plans.bronze import load_time
from retail_lake.schemas import DIM_CUSTOMERS, DIM_PRODUCTS, FCT_INVENTORY, FCT_SALES, conform

# Fixed values of the models.
CANCELLED = "Cancelled"
AMAZON, INTERNATIONAL = "AMAZON", "INTERNATIONAL"
INTERNATIONAL_COUNTRY = "International"
INTERNATIONAL_STATUS = "Completed"
INTERNATIONAL_CURRENCY = "USD"

NULL_STR = "CAST(NULL AS STRING)"
NOT_CANCELLED = f"order_status NOT IN ('{CANCELLED}')"


def not_cancelled(df: DataFrame) -> DataFrame:
    """order_status NOT IN ('Cancelled'): exact case; a NULL status is dropped too."""
    return df.where(NOT_CANCELLED)


# ---------------------------------------------------------------- M4 customers
def customer_sides(stg_amazon: DataFrame, stg_intl: DataFrame) -> DataFrame:
    """Both DISTINCT customer CTEs stacked as an outer union (ac_* / ic_* columns)."""
    ac = stg_amazon.selectExpr(
        f"'{AMAZON}' AS ac_source_system", "order_id AS ac_transaction_id", "ship_city AS ac_city",
        "ship_state AS ac_state", "ship_country AS ac_country", "is_b2b AS ac_is_business_customer",
    ).distinct()
    ic = stg_intl.selectExpr(
        f"'{INTERNATIONAL}' AS ic_source_system", "customer_name AS ic_customer_name",
        f"{NULL_STR} AS ic_city", f"{NULL_STR} AS ic_state",
        f"'{INTERNATIONAL_COUNTRY}' AS ic_country", "false AS ic_is_business_customer",
    ).distinct()
    return disjoint_outer_union(ac, ic)


def customer_key(order_id: str, customer_name: str) -> str:
    """MD5 of COALESCE(order,'') || COALESCE(name,''), lower-case hex."""
    return f"md5(concat(coalesce({order_id}, ''), coalesce({customer_name}, '')))"


def dim_customers(stg_amazon: DataFrame, stg_intl: DataFrame, resolved: bool = False) -> DataFrame:
    """Customer dimension.

    ``resolved=False`` projects exactly as the reference: location and B2B come
    only from the marketplace side, source_system only from the international
    side. ``resolved=True`` takes each attribute from whichever side the row
    came from.
    """
    def pick(attr: str) -> str:
        return f"coalesce(ac_{attr}, ic_{attr})" if resolved else None

    out = customer_sides(stg_amazon, stg_intl).selectExpr(
        f"{customer_key('ac_transaction_id', 'ic_customer_name')} AS customer_id",
        "ic_customer_name AS customer_name",
        "ac_transaction_id AS amazon_order_id",
        f"{pick('city') or 'ac_city'} AS city",
        f"{pick('state') or 'ac_state'} AS state",
        f"{pick('country') or 'ac_country'} AS country",
        f"{pick('is_business_customer') or 'ac_is_business_customer'} AS is_business_customer",
        f"{pick('source_system') or 'ic_source_system'} AS source_system",
    )
    return conform(out, DIM_CUSTOMERS)


# ----------------------------------------------------------------- M5 products
def dim_products(stg_stock: DataFrame, stg_amazon: DataFrame, stg_intl: DataFrame,
                 load_ts, one_row_per_sku: bool = False) -> DataFrame:
    """Product dimension.

    Reference semantics: ``stock FULL JOIN amazon ON sku FULL JOIN intl ON
    stock.sku`` then DISTINCT. Because the second condition uses only the stock
    key, marketplace-only and international-only rows of one SKU never merge.

    The pair fan-out of that many-to-many join is never built. For a stock row
    the marketplace side only decides whether a prefix rule can fire (its SKU
    equals the stock SKU) and its size is shadowed by the stock size (never
    NULL after bronze), so it enters as a semi-join flag; the international
    side contributes its distinct styles. Unmatched marketplace and
    international rows come from anti-joins. The final DISTINCT gives the same
    rows as the reference (checked against the literal SQL).
    """
    s = stg_stock.select("sku_code", "design_number", "size", "color", "category")
    a = stg_amazon.where(f"sku != '{UNKNOWN}'").select("sku", "category", "size").distinct()
    i = stg_intl.where(f"sku != '{UNKNOWN}'").select("sku", "style", "size").distinct()
    stock_keys = s.selectExpr("sku_code AS k").distinct()
    a_keys = a.selectExpr("sku AS a_sku").distinct()
    i_styles = i.selectExpr("sku AS i_sku", "style AS i_style").distinct()

    stocked = (s.join(a_keys, F.expr("sku_code = a_sku"), "left")
                .join(i_styles, F.expr("sku_code = i_sku"), "left")
                .selectExpr(
                    "sku_code AS product_sku", "design_number",
                    f"{product_category('sku_code', 'a_sku', 'i_style')} AS product_category",
                    "i_style AS style", f"coalesce(size, '{UNKNOWN}') AS size", "color",
                    "category AS stock_category"))
    a_only = (a.join(stock_keys, F.expr("sku = k"), "left_anti")
               .selectExpr("sku AS product_sku", f"{NULL_STR} AS design_number",
                           f"{product_category(NULL_STR, 'sku', NULL_STR)} AS product_category",
                           f"{NULL_STR} AS style", f"coalesce(size, '{UNKNOWN}') AS size",
                           f"{NULL_STR} AS color", f"{NULL_STR} AS stock_category"))
    i_only = (i.join(stock_keys, F.expr("sku = k"), "left_anti")
               .selectExpr("sku AS product_sku", f"{NULL_STR} AS design_number",
                           f"{product_category(NULL_STR, NULL_STR, 'style')} AS product_category",
                           "style", f"coalesce(size, '{UNKNOWN}') AS size",
                           f"{NULL_STR} AS color", f"{NULL_STR} AS stock_category"))

    products = union_all(stocked, a_only, i_only).distinct()
    if one_row_per_sku:
        products = one_row_per_key(products)
    return conform(products.where("product_sku IS NOT NULL")
                           .selectExpr("*", f"{load_time(load_ts)} AS updated_timestamp"), DIM_PRODUCTS)


PRODUCT_ATTRS = ["design_number", "product_category", "style", "size", "color", "stock_category"]
PICK_ORDER = ["product_category", "style", "size", "color", "design_number", "stock_category"]


def one_row_per_key(products: DataFrame) -> DataFrame:
    """Keep one row per product_sku: stock-backed first, then category, style,
    size, color (NULLs last), via a min over an ordered struct.

    A grouped min uses partial aggregation, so even a SKU with very many
    attribute combinations is reduced map-side before the shuffle.
    """
    order = ", ".join(["stock_category IS NULL"] + [f"{c} IS NULL, {c}" for c in PICK_ORDER])
    payload = ", ".join(PRODUCT_ATTRS)
    best = products.groupBy("product_sku").agg(F.expr(f"min(struct({order}, struct({payload}) AS row)) AS best"))
    return best.selectExpr("product_sku", *[f"best.row.{c} AS {c}" for c in PRODUCT_ATTRS])


# ------------------------------------------------------------- M6 inventory
# Deterministic order inside a SKU: time first, then the row's own values.
SNAPSHOT_ORDER = ("snapshot_date ASC NULLS LAST, stock_quantity ASC NULLS LAST, size ASC NULLS LAST, "
                  "color ASC NULLS LAST, category ASC NULLS LAST")


def fct_inventory(stg_stock_history: DataFrame) -> DataFrame:
    snaps = stg_stock_history.selectExpr(
        "sku_code AS product_sku", "stock_quantity", "category", "size", "color",
        "loaded_timestamp AS snapshot_date")
    with_prev = lag_delta(snaps, "product_sku", SNAPSHOT_ORDER, "stock_quantity",
                          "previous_stock_quantity", "stock_change")
    out = with_prev.selectExpr("*", f"{stock_status('stock_quantity')} AS stock_status",
                               f"{reorder_suggestion('stock_quantity')} AS reorder_suggestion")
    return conform(out, FCT_INVENTORY)


# ----------------------------------------------------------------- M7 sales
def sales_channels(stg_amazon: DataFrame, stg_intl: DataFrame) -> DataFrame:
    """Both channels in one 12-column shape (UNION ALL)."""
    amazon = not_cancelled(stg_amazon).selectExpr(
        "order_id AS sales_id", "order_date", "order_status", "sku", "quantity", "amount", "currency",
        "ship_city", "ship_state", "ship_country", "is_b2b", f"'{AMAZON}' AS sales_channel")
    intl = stg_intl.selectExpr(
        "transaction_id AS sales_id", "order_date", f"'{INTERNATIONAL_STATUS}' AS order_status", "sku",
        "quantity", "gross_amount AS amount", f"'{INTERNATIONAL_CURRENCY}' AS currency",
        f"{NULL_STR} AS ship_city", f"{NULL_STR} AS ship_state",
        f"'{INTERNATIONAL_COUNTRY}' AS ship_country", "false AS is_b2b",
        f"'{INTERNATIONAL}' AS sales_channel")
    return union_all(amazon, intl)


def fct_sales(stg_amazon: DataFrame, stg_intl: DataFrame, products: DataFrame,
              usd_inr: float) -> DataFrame:
    """Sales fact: channel union LEFT JOIN product dimension.

    The product columns come from the dimension side, so an unmatched SKU has
    NULL product_sku. If the dimension has several rows per SKU (reference
    variant) the sale is repeated once per row, as in the reference. The
    join is a plain equi-join: AQE broadcasts the dimension when its runtime
    size allows and otherwise sort-merges, splitting hot SKUs.
    """
    s = sales_channels(stg_amazon, stg_intl).where("sales_id IS NOT NULL")
    p = products.selectExpr("product_sku", "product_category", "size AS p_size", "color")
    out = s.join(p, F.expr("sku = product_sku"), "left").selectExpr(
        "sales_id", "order_date", "order_status", "product_sku", "product_category",
        "p_size AS size", "color", "quantity", "amount",
        f"{safe_ratio('amount', 'quantity')} AS unit_price",
        "currency", "ship_city", "ship_state", "ship_country", "is_b2b", "sales_channel",
        "amount AS gross_revenue",
        f"{to_inr('amount', 'currency', usd_inr)} AS gross_revenue_inr",
        "year(order_date) AS order_year", "month(order_date) AS order_month",
        "date_format(order_date, 'yyyy-MM') AS order_year_month",
    )
    return conform(out, FCT_SALES)


def product_match_keys(stg_stock: DataFrame, stg_amazon: DataFrame, stg_intl: DataFrame) -> DataFrame:
    """Distinct key combinations of ``stock FULL JOIN amazon ON sku FULL JOIN
    intl ON stock.sku``: (product_sku, stock_sku, amazon_sku, intl_sku,
    intl_style). Built from a left join per stock SKU plus two anti-joins, so
    the many-to-many pair fan-out never exists."""
    s = stg_stock.selectExpr("sku_code").distinct()
    a = stg_amazon.where(f"sku != '{UNKNOWN}'").selectExpr("sku AS a_sku").distinct()
    i = stg_intl.where(f"sku != '{UNKNOWN}'").selectExpr("sku AS i_sku", "style AS i_style").distinct()
    stocked = (s.join(a, F.expr("sku_code = a_sku"), "left").join(i, F.expr("sku_code = i_sku"), "left")
                .selectExpr("sku_code AS product_sku", "sku_code AS stock_sku", "a_sku AS amazon_sku",
                            "i_sku AS intl_sku", "i_style AS intl_style"))
    a_only = (a.join(s, F.expr("a_sku = sku_code"), "left_anti")
               .selectExpr("a_sku AS product_sku", f"{NULL_STR} AS stock_sku", "a_sku AS amazon_sku",
                           f"{NULL_STR} AS intl_sku", f"{NULL_STR} AS intl_style"))
    i_only = (i.join(s, F.expr("i_sku = sku_code"), "left_anti")
               .selectExpr("i_sku AS product_sku", f"{NULL_STR} AS stock_sku", f"{NULL_STR} AS amazon_sku",
                           "i_sku AS intl_sku", "i_style AS intl_style"))
    return union_all(stocked, a_only, i_only).distinct()
