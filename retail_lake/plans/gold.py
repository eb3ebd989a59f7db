"""Gold layer: inventory health and sales summaries (M8-M10)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.functions.rules import (
    daily_sales_rate, days_of_inventory, inventory_action, revenue_tier, safe_ratio,
    share_of_total, suggested_reorder,
)
from retail_lake.operators.aggregates import grand_total, orders_and_months
from retail_lake.operators.ranking import global_rank, global_ranks
from retail_lake.operators.stages import stage
from retail_lake.operators.windows import moving_average
from retail_lake.params import MOVING_AVG_ROWS, RECENT_SALES_DAYS
from retail_lake.plans.silver import NOT_CANCELLED, SNAPSHOT_ORDER
from retail_lake.schemas import (
    INVENTORY_ANALYSIS, SALES_SUMMARY_BY_PRODUCT, SALES_SUMMARY_BY_REGION, conform,
)


def _date(d) -> str:
    if isinstance(d, dt.datetime):
        d = d.date()
    return f"DATE '{d.isoformat()}'"


def aggregate(df: DataFrame, keys: list[str], exprs: list[str]) -> DataFrame:
    """groupBy(keys).agg(...) with the aggregates given as SQL expression text."""
    return df.groupBy(*keys).agg(*[F.expr(e) for e in exprs])


def _sorted_with_ties_split(column: str, descending: bool, tie_breakers: list[str]):
    """The model's ORDER BY plus the row's own keys as tie-breakers.

    A global sort range-partitions on the sort key; when one value holds a
    large share of the rows (e.g. the 999 'no sales' sentinel) every such row
    would land in one task. With the keys appended the range bounds can split
    the tie, and the order the model promises is unchanged.
    """
    first = F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()
    return [first] + [F.col(k).asc_nulls_last() for k in tie_breakers]


def recent_units(fct_sales: DataFrame, as_of, days: int = RECENT_SALES_DAYS) -> DataFrame:
    """Units sold per product since ``as_of - days`` (inclusive), pre-aggregated.

    Grouping before the join keeps the join input at one row per SKU; partial
    aggregation makes a hot SKU cost one row per map task. The fact is laid out
    by month, so the condition on the month leaves the window's folders only.
    """
    first = f"date_sub({_date(as_of)}, {days})"
    recent = fct_sales.where(f"order_year_month >= date_format({first}, 'yyyy-MM') AND order_date >= {first}")
    return aggregate(recent, ["product_sku"], ["sum(quantity) AS total_sold_30days"])


def inventory_analysis(fct_inventory: DataFrame, fct_sales: DataFrame, as_of,
                       days: int = RECENT_SALES_DAYS, sort: bool = True) -> DataFrame:
    inv = moving_average(fct_inventory, "product_sku", SNAPSHOT_ORDER, "stock_change",
                         "avg_weekly_stock_change", MOVING_AVG_ROWS)
    sold = recent_units(fct_sales, as_of, days)
    units = "CAST(coalesce(total_sold_30days, 0) AS BIGINT)"
    health = inv.join(sold, "product_sku", "left").selectExpr(
        "product_sku", "category", "size", "color", "stock_quantity", "stock_status",
        "reorder_suggestion", "snapshot_date", f"{units} AS units_sold_30days",
        f"{daily_sales_rate(units, days)} AS daily_sales_rate",
        f"{days_of_inventory('stock_quantity', units, days)} AS days_of_inventory",
        "avg_weekly_stock_change")
    final = health.selectExpr(
        "*", f"{inventory_action('days_of_inventory')} AS inventory_action_required",
        f"{suggested_reorder('days_of_inventory', 'daily_sales_rate', 'stock_quantity', days)}"
        " AS suggested_reorder_quantity",
    ).where("stock_quantity > 0 OR units_sold_30days > 0")
    out = conform(final, INVENTORY_ANALYSIS)
    return out.orderBy(*_sorted_with_ties_split("days_of_inventory", False, ["product_sku", "snapshot_date"])) \
        if sort else out


PRODUCT_KEYS = ["product_sku", "product_category", "size", "color", "sales_channel"]
# Multiples of 1/1024 add up without rounding, and so little is left beside them that the order of a
# sum's rows, which differs between runs, does not show in an average.
PRICE_GRID = "(rint(unit_price * 1024D) / 1024D)"
REGION_KEYS = ["ship_state", "ship_city", "ship_country", "sales_channel"]
B2B_SHARE = "round(" + safe_ratio("100.0D * CAST(_b2b AS DOUBLE)", "CAST(_revenue AS DOUBLE)") + ", 2)"


def product_sales(fct_sales: DataFrame) -> DataFrame:
    """Per product x channel KPIs, including two distinct counts in one pass: orders by the first row of each,
    months as bits of a fixed domain."""
    g = orders_and_months(fct_sales.where(NOT_CANCELLED), PRODUCT_KEYS, "sales_id", "order_date", {
        "total_units_sold": ("sum(quantity)", "sum"),
        "_revenue": ("sum(gross_revenue_inr)", "sum"),
        "_price": (f"sum({PRICE_GRID})", "sum"),
        "_price_rest": (f"sum(unit_price - {PRICE_GRID})", "sum"),
        "_prices": ("count(unit_price)", "sum"),
        "first_sale_date": ("min(order_date)", "min"),
        "last_sale_date": ("max(order_date)", "max"),
    }, "total_transactions", "active_months")
    return g.selectExpr(
        *PRODUCT_KEYS, "total_transactions", "CAST(total_units_sold AS BIGINT) AS total_units_sold",
        "CAST(_revenue AS DOUBLE) AS total_revenue_inr", "try_divide(_price + _price_rest, _prices) AS avg_selling_price",
        "active_months", "first_sale_date", "last_sale_date",
        f"{safe_ratio('_revenue', 'total_transactions')} AS avg_order_value", "_revenue")


def sales_summary_by_product(fct_sales: DataFrame, sort: bool = True) -> DataFrame:
    # the aggregate feeds the rows and both rank tables: compute it once
    return ranked_products(stage(product_sales(fct_sales), "product_sales"), sort)


def ranked_products(ps: DataFrame, sort: bool = True) -> DataFrame:
    """The product summary from its written aggregate."""
    ranked = global_ranks(ps, {"revenue_rank": "_revenue", "volume_rank": "total_units_sold"})
    out = conform(ranked.selectExpr("*", f"{revenue_tier('_revenue')} AS revenue_tier"),
                  SALES_SUMMARY_BY_PRODUCT)
    return out.orderBy(*_sorted_with_ties_split("total_revenue_inr", True, PRODUCT_KEYS)) if sort else out


def regional_sales(fct_sales: DataFrame) -> DataFrame:
    g = aggregate(fct_sales.where(f"{NOT_CANCELLED} AND ship_state IS NOT NULL"), REGION_KEYS, [
        "count(DISTINCT sales_id) AS total_orders",
        "sum(quantity) AS total_units",
        "sum(gross_revenue_inr) AS _revenue",
        "avg(unit_price) AS avg_price",
        "sum(CASE WHEN is_b2b THEN gross_revenue_inr ELSE 0 END) AS _b2b",
        "sum(CASE WHEN NOT is_b2b THEN gross_revenue_inr ELSE 0 END) AS _b2c",
    ])
    return g.selectExpr(
        *REGION_KEYS, "total_orders", "CAST(total_units AS BIGINT) AS total_units",
        "CAST(_revenue AS DOUBLE) AS total_revenue_inr", "avg_price",
        "CAST(_b2b AS DOUBLE) AS b2b_revenue", "CAST(_b2c AS DOUBLE) AS b2c_revenue",
        f"{B2B_SHARE} AS b2b_percentage",
        "_revenue")


def sales_summary_by_region(fct_sales: DataFrame, sort: bool = True) -> DataFrame:
    # the aggregate feeds the rows, the grand total and the rank table: compute it once
    return ranked_regions(stage(regional_sales(fct_sales), "regional_sales"), sort)


def ranked_regions(r: DataFrame, sort: bool = True) -> DataFrame:
    """The regional summary from its written aggregate."""
    total = grand_total(r, "_revenue")
    shared = r.withColumn("revenue_share_percentage",
                          F.round(F.try_divide(F.lit(100.0) * F.col("_revenue").cast("double"),
                                               total.cast("double")), 2))
    ranked = global_rank(shared, "_revenue", "state_rank")
    out = conform(ranked, SALES_SUMMARY_BY_REGION)
    return out.orderBy(*_sorted_with_ties_split("total_revenue_inr", True, REGION_KEYS)) if sort else out
