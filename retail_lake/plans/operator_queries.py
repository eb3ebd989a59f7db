"""One query per operator of the layer models, each over the whole inputs.

Every function takes a ``Lake`` and returns a DataFrame that isolates one
operator (or a tight group) of the models, so its result can be checked on
its own against the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.functions.cleaning import (
    clamp_count, clean_text, flag_or_false, number_or_zero, parse_dmy, text_or_default,
    transaction_key,
)
from retail_lake.functions.rules import revenue_tier, safe_ratio, to_inr
from retail_lake.lake import Lake
from retail_lake.operators.aggregates import grand_total, orders_and_months
from retail_lake.operators.ranking import global_ranks
from retail_lake.operators.windows import lag_delta, moving_average
from retail_lake.params import MOVING_AVG_ROWS
from retail_lake.plans import gold, silver
from retail_lake.plans.silver import NOT_CANCELLED, SNAPSHOT_ORDER


def clean_text_defaults(lake: Lake) -> DataFrame:      # P2, P3 at every site; fields a file lacks are NULL
    amazon = lake.raw_amazon_sales.selectExpr(
        "'AMAZON' AS channel", f"{clean_text('Order ID')} AS order_id",
        f"{text_or_default('Status')} AS order_status", f"{clean_text('Fulfilment')} AS fulfilment_type",
        f"{clean_text('Sales Channel ')} AS sales_channel", f"{text_or_default('SKU')} AS sku",
        f"{clean_text('Category')} AS category", f"{clean_text('Size')} AS size",
        f"{text_or_default('currency', 'INR')} AS currency", f"{clean_text('ship-city')} AS ship_city",
        f"{clean_text('ship-state')} AS ship_state", f"{clean_text('ship-country')} AS ship_country")
    intl = lake.raw_international_sales.selectExpr(
        "'INTERNATIONAL' AS channel", f"{text_or_default('CUSTOMER')} AS customer_name",
        f"{clean_text('Months')} AS month_year", f"{clean_text('Style')} AS style",
        f"{clean_text('SKU')} AS sku", f"{clean_text('Size')} AS size")
    stock = lake.raw_stock_levels.selectExpr(
        "'STOCK' AS channel", f"{clean_text('SKU Code')} AS sku", f"{clean_text('Design No.')} AS design_number",
        f"{text_or_default('Category')} AS category", f"{text_or_default('Size')} AS size",
        f"{text_or_default('Color')} AS color")
    return (amazon.unionByName(intl, allowMissingColumns=True)
                  .unionByName(stock, allowMissingColumns=True))


def clamp_quantity(lake: Lake) -> DataFrame:               # P4, P5
    amazon = lake.raw_amazon_sales.selectExpr(
        "'AMAZON' AS channel", "`Qty` AS raw_quantity", f"{clamp_count('Qty', 0)} AS quantity")
    intl = lake.raw_international_sales.selectExpr(
        "'INTERNATIONAL' AS channel", "`PCS` AS raw_quantity", f"{clamp_count('PCS', 1)} AS quantity")
    return amazon.unionByName(intl)


def numeric_boolean_defaults(lake: Lake) -> DataFrame: # P6 at every site, P7 (the marketplace file only)
    def money(c: str, name: str) -> list[str]:
        return [f"`{c}` AS raw_{name}", f"CAST({number_or_zero(c)} AS DECIMAL(18,2)) AS {name}"]
    amazon = lake.raw_amazon_sales.selectExpr(
        "'AMAZON' AS channel", *money("Amount", "amount"), "`B2B` AS raw_b2b", f"{flag_or_false('B2B')} AS is_b2b")
    intl = lake.raw_international_sales.selectExpr(
        "'INTERNATIONAL' AS channel", *money("GROSS AMT", "amount"), *money("RATE", "unit_price"))
    return amazon.unionByName(intl, allowMissingColumns=True)


def parse_dmy_date(lake: Lake) -> DataFrame:               # P8
    amazon = lake.raw_amazon_sales.selectExpr("`Date` AS date_raw", f"{parse_dmy('Date')} AS order_date")
    intl = lake.raw_international_sales.selectExpr("`DATE` AS date_raw", f"{parse_dmy('DATE')} AS order_date")
    return amazon.unionByName(intl).distinct()


def transaction_key_query(lake: Lake) -> DataFrame:        # P9
    return lake.raw_international_sales.selectExpr(
        "`CUSTOMER` AS customer_raw", "`SKU` AS sku_raw", "`DATE` AS date_raw",
        f"{transaction_key('CUSTOMER', 'SKU', 'DATE')} AS transaction_id")


def required_key_filter(lake: Lake) -> DataFrame:          # F1
    def counts(df: DataFrame, table: str, key: str) -> DataFrame:
        return df.selectExpr(f"'{table}' AS table_name", f"trim({key}) IS NOT NULL AS kept").groupBy(
            "table_name").agg(F.expr("count(*) AS raw_rows"),
                              F.expr("CAST(sum(CASE WHEN kept THEN 1 ELSE 0 END) AS BIGINT) AS kept_rows"),
                              F.expr("CAST(sum(CASE WHEN kept THEN 0 ELSE 1 END) AS BIGINT) AS dropped_rows"))
    return (counts(lake.raw_amazon_sales, "stg_amazon_sales", "`Order ID`")
            .unionByName(counts(lake.raw_international_sales, "stg_international_sales", "`SKU`"))
            .unionByName(counts(lake.raw_stock_levels, "stg_stock_levels", "`SKU Code`")))


def exclude_cancelled(lake: Lake) -> DataFrame:            # F2
    return lake.stg_amazon_sales.where(NOT_CANCELLED).select("order_id", "sku", "order_status")


def drop_unknown_sku(lake: Lake) -> DataFrame:         # F3 on both channels, every row that stays
    amazon = lake.stg_amazon_sales.where("sku != 'Unknown'").selectExpr(
        "'AMAZON' AS channel", "order_id AS sales_id", "sku", "category", "size")
    intl = lake.stg_international_sales.where("sku != 'Unknown'").selectExpr(
        "'INTERNATIONAL' AS channel", "transaction_id AS sales_id", "sku", "style", "size")
    return amazon.unionByName(intl, allowMissingColumns=True)


def rolling_30day_units(lake: Lake) -> DataFrame:          # F4, A1
    return gold.recent_units(lake.fct_sales_once(), lake.params.as_of)


def _inventory_with_recent(lake: Lake) -> DataFrame:
    recent = gold.recent_units(lake.fct_sales_once(), lake.params.as_of)
    return lake.fct_inventory.join(recent, "product_sku", "left")


def active_stock_filter(lake: Lake) -> DataFrame:          # F5
    return _inventory_with_recent(lake).selectExpr(
        "product_sku", "snapshot_date", "stock_quantity",
        "CAST(coalesce(total_sold_30days, 0) AS BIGINT) AS units_sold_30days",
    ).where("stock_quantity > 0 OR units_sold_30days > 0")


def left_join_product(lake: Lake) -> DataFrame:            # J1
    s = silver.sales_channels(lake.stg_amazon_sales, lake.stg_international_sales)
    p = lake.dim_products().select("product_sku", "product_category")
    return s.join(p, F.expr("sku = product_sku"), "left").select(
        "sales_id", "sales_channel", "sku", "product_sku", "product_category")


def left_join_recent_sales(lake: Lake) -> DataFrame:       # J2
    return _inventory_with_recent(lake).select(
        "product_sku", "snapshot_date", "stock_quantity", "total_sold_30days")


def full_outer_products(lake: Lake) -> DataFrame:          # J3
    return silver.product_match_keys(lake.stg_stock_levels, lake.stg_amazon_sales,
                                     lake.stg_international_sales)


def disjoint_outer_union(lake: Lake) -> DataFrame:         # J4
    return silver.customer_sides(lake.stg_amazon_sales, lake.stg_international_sales)


def share_of_total(lake: Lake) -> DataFrame:               # J5, A8, A9
    by_state = gold.aggregate(lake.fct_sales_once().where(f"{NOT_CANCELLED} AND ship_state IS NOT NULL"),
                         ["ship_state"], ["sum(gross_revenue_inr) AS _revenue"])
    total = grand_total(by_state, "_revenue")
    return by_state.select(
        "ship_state", F.col("_revenue").cast("double").alias("total_revenue_inr"),
        F.round(F.try_divide(F.lit(100.0) * F.col("_revenue").cast("double"), total.cast("double")), 2)
         .alias("revenue_share_percentage"))


def count_distinct_orders(lake: Lake) -> DataFrame:        # A2
    return orders_and_months(lake.fct_sales_once().where(NOT_CANCELLED), ["product_sku", "sales_channel"], "sales_id",
                             "order_date", {}, "total_transactions", "active_months")


def price_stats(lake: Lake) -> DataFrame:                  # A3, A4
    return gold.aggregate(lake.fct_sales_once().where(NOT_CANCELLED), ["product_sku"], [
        "avg(unit_price) AS avg_selling_price",
        "min(order_date) AS first_sale_date", "max(order_date) AS last_sale_date"])


def conditional_revenue(lake: Lake) -> DataFrame:          # A5, A6
    g = gold.aggregate(lake.fct_sales_once().where(f"{NOT_CANCELLED} AND ship_state IS NOT NULL"), ["ship_state"], [
        "sum(gross_revenue_inr) AS _revenue",
        "sum(CASE WHEN is_b2b THEN gross_revenue_inr ELSE 0 END) AS _b2b",
        "sum(CASE WHEN NOT is_b2b THEN gross_revenue_inr ELSE 0 END) AS _b2c"])
    return g.selectExpr(
        "ship_state", "CAST(_b2b AS DOUBLE) AS b2b_revenue", "CAST(_b2c AS DOUBLE) AS b2c_revenue",
        "round(" + safe_ratio("100.0D * CAST(_b2b AS DOUBLE)", "CAST(_revenue AS DOUBLE)") + ", 2) AS b2b_percentage")


def distinct_sku_attributes(lake: Lake) -> DataFrame:  # A10 on both channels
    amazon = lake.stg_amazon_sales.where("sku != 'Unknown'").selectExpr(
        "'AMAZON' AS channel", "sku", "category", "size").distinct()
    intl = lake.stg_international_sales.where("sku != 'Unknown'").selectExpr(
        "'INTERNATIONAL' AS channel", "sku", "style", "size").distinct()
    return amazon.unionByName(intl, allowMissingColumns=True)


def lag_delta_query(lake: Lake) -> DataFrame:              # W1, W2
    snaps = lake.stg_stock_history.selectExpr(
        "sku_code AS product_sku", "stock_quantity", "category", "size", "color",
        "loaded_timestamp AS snapshot_date")
    return lag_delta(snaps, "product_sku", SNAPSHOT_ORDER, "stock_quantity",
                     "previous_stock_quantity", "stock_change").select(
        "product_sku", "snapshot_date", "stock_quantity", "previous_stock_quantity", "stock_change")


def moving_average_7(lake: Lake) -> DataFrame:             # W3
    return moving_average(lake.fct_inventory, "product_sku", SNAPSHOT_ORDER, "stock_change",
                          "avg_weekly_stock_change", MOVING_AVG_ROWS).select(
        "product_sku", "snapshot_date", "stock_change", "avg_weekly_stock_change")


def _revenue_by_sku(lake: Lake) -> DataFrame:
    g = gold.aggregate(lake.fct_sales_once().where(NOT_CANCELLED), ["product_sku"], [
        "sum(gross_revenue_inr) AS _revenue", "sum(quantity) AS _units"])
    return g.selectExpr("product_sku", "CAST(_revenue AS DOUBLE) AS total_revenue_inr",
                        "CAST(_units AS BIGINT) AS total_units_sold")


def global_rank_query(lake: Lake) -> DataFrame:            # W4
    return global_ranks(_revenue_by_sku(lake),
                        {"revenue_rank": "total_revenue_inr", "volume_rank": "total_units_sold"})


def ordered_products(lake: Lake) -> DataFrame:            # O1
    return _revenue_by_sku(lake).orderBy(F.col("total_revenue_inr").desc_nulls_last(),
                                         F.col("product_sku").asc_nulls_last())


def channel_union(lake: Lake) -> DataFrame:                # U1
    return silver.sales_channels(lake.stg_amazon_sales, lake.stg_international_sales)


def md5_customer_key(lake: Lake) -> DataFrame:             # E4
    amazon = lake.stg_amazon_sales.selectExpr(
        "'AMAZON' AS source_system", "order_id AS source_key",
        f"{silver.customer_key('order_id', 'CAST(NULL AS STRING)')} AS customer_id")
    intl = lake.stg_international_sales.selectExpr(
        "'INTERNATIONAL' AS source_system", "customer_name AS source_key",
        f"{silver.customer_key('CAST(NULL AS STRING)', 'customer_name')} AS customer_id")
    return amazon.unionByName(intl).distinct()


def product_category_rules(lake: Lake) -> DataFrame:       # E7
    return lake.dim_products().select("product_sku", "product_category").distinct()


def currency_to_inr(lake: Lake) -> DataFrame:              # E8
    u = silver.sales_channels(lake.stg_amazon_sales, lake.stg_international_sales)
    return u.selectExpr("sales_id", "sales_channel", "currency", "amount",
                        f"CAST({to_inr('amount', 'currency', lake.params.usd_inr)} AS DECIMAL(28,6))"
                        " AS gross_revenue_inr")


def order_calendar(lake: Lake) -> DataFrame:               # E9, E10
    u = silver.sales_channels(lake.stg_amazon_sales, lake.stg_international_sales)
    return u.selectExpr("order_date", "year(order_date) AS order_year", "month(order_date) AS order_month",
                        "date_format(order_date, 'yyyy-MM') AS order_year_month").distinct()


def stock_status_rules(lake: Lake) -> DataFrame:           # E11, E12
    return lake.fct_inventory.select("stock_quantity", "stock_status", "reorder_suggestion").distinct()


def reorder_metrics(lake: Lake) -> DataFrame:              # E13-E16
    return gold.inventory_analysis(lake.fct_inventory, lake.fct_sales_once(), lake.params.as_of, sort=False).select(
        "product_sku", "snapshot_date", "units_sold_30days", "daily_sales_rate", "days_of_inventory",
        "inventory_action_required", "suggested_reorder_quantity")


def revenue_tier_query(lake: Lake) -> DataFrame:           # E17
    return _revenue_by_sku(lake).selectExpr(
        "product_sku", "total_revenue_inr", f"{revenue_tier('total_revenue_inr')} AS revenue_tier")


OPERATOR_QUERIES = {
    "clean_text_defaults": (clean_text_defaults, "P2 P3"),
    "clamp_quantity": (clamp_quantity, "P4 P5"),
    "numeric_boolean_defaults": (numeric_boolean_defaults, "P6 P7"),
    "parse_dmy_date": (parse_dmy_date, "P8"),
    "transaction_key": (transaction_key_query, "P9"),
    "required_key_filter": (required_key_filter, "F1"),
    "exclude_cancelled": (exclude_cancelled, "F2"),
    "drop_unknown_sku": (drop_unknown_sku, "F3"),
    "rolling_30day_units": (rolling_30day_units, "F4 A1"),
    "active_stock_filter": (active_stock_filter, "F5"),
    "left_join_product": (left_join_product, "J1"),
    "left_join_recent_sales": (left_join_recent_sales, "J2"),
    "full_outer_products": (full_outer_products, "J3"),
    "disjoint_outer_union": (disjoint_outer_union, "J4"),
    "share_of_total": (share_of_total, "J5 A8 A9"),
    "count_distinct_orders": (count_distinct_orders, "A2"),
    "price_stats": (price_stats, "A3 A4"),
    "conditional_revenue": (conditional_revenue, "A5 A6"),
    "distinct_sku_attributes": (distinct_sku_attributes, "A10"),
    "lag_delta": (lag_delta_query, "W1 W2"),
    "moving_average_7": (moving_average_7, "W3"),
    "global_rank": (global_rank_query, "W4"),
    "ordered_products": (ordered_products, "O1"),
    "channel_union": (channel_union, "U1"),
    "md5_customer_key": (md5_customer_key, "E4"),
    "product_category_rules": (product_category_rules, "E7"),
    "currency_to_inr": (currency_to_inr, "E8"),
    "order_calendar": (order_calendar, "E9 E10"),
    "stock_status_rules": (stock_status_rules, "E11 E12"),
    "reorder_metrics": (reorder_metrics, "E13-E16"),
    "revenue_tier": (revenue_tier_query, "E17"),
}
