"""Explicit schemas (contract) for raw inputs and every model output.

Raw headers are kept verbatim, including the trailing space of
"Sales Channel " and the dot of "Design No."; nothing is ever inferred.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType,
    StringType, StructField, StructType, TimestampNTZType,
)

from retail_lake.functions.sql import q

MONEY = DecimalType(18, 2)
MONEY_INR = DecimalType(28, 6)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


# Driver star-schema tables read by the fixture mapping (declared, never inferred).
STAR_SCHEMAS = {
    "lineitem": _s(("l_orderkey", LongType()), ("l_partkey", LongType()), ("l_suppkey", LongType()),
                   ("l_linenumber", IntegerType()), ("l_quantity", DoubleType()),
                   ("l_extendedprice", DoubleType()), ("l_discount", DoubleType()), ("l_tax", DoubleType()),
                   ("l_returnflag", StringType()), ("l_linestatus", StringType()),
                   ("l_shipdate", TimestampNTZType())),
    "orders": _s(("o_orderkey", LongType()), ("o_custkey", LongType()), ("o_orderstatus", StringType()),
                 ("o_totalprice", DoubleType()), ("o_orderdate", TimestampNTZType()),
                 ("o_orderpriority", StringType())),
    "part": _s(("p_partkey", LongType()), ("p_name", StringType()), ("p_brand", StringType()),
               ("p_type", StringType()), ("p_size", IntegerType()), ("p_retailprice", DoubleType())),
    "customer": _s(("c_custkey", LongType()), ("c_name", StringType()), ("c_nationkey", IntegerType()),
                   ("c_acctbal", DoubleType()), ("c_mktsegment", StringType())),
    "nation": _s(("n_nationkey", IntegerType()), ("n_name", StringType()), ("n_regionkey", IntegerType())),
}

RAW_AMAZON_SALES = _s(
    ("Order ID", StringType()), ("Date", StringType()), ("Status", StringType()),
    ("Fulfilment", StringType()), ("Sales Channel ", StringType()), ("SKU", StringType()),
    ("Category", StringType()), ("Size", StringType()), ("Qty", IntegerType()),
    ("Amount", MONEY), ("currency", StringType()), ("ship-city", StringType()),
    ("ship-state", StringType()), ("ship-postal-code", StringType()),
    ("ship-country", StringType()), ("B2B", BooleanType()),
)

RAW_INTERNATIONAL_SALES = _s(
    ("CUSTOMER", StringType()), ("SKU", StringType()), ("DATE", StringType()),
    ("Months", StringType()), ("Style", StringType()), ("Size", StringType()),
    ("PCS", IntegerType()), ("RATE", MONEY), ("GROSS AMT", MONEY),
)

RAW_STOCK_LEVELS = _s(
    ("SKU Code", StringType()), ("Design No.", StringType()), ("Stock", IntegerType()),
    ("Category", StringType()), ("Size", StringType()), ("Color", StringType()),
)

RAW_SCHEMAS = {
    "raw_amazon_sales": RAW_AMAZON_SALES,
    "raw_international_sales": RAW_INTERNATIONAL_SALES,
    "raw_stock_levels": RAW_STOCK_LEVELS,
}

STG_AMAZON_SALES = _s(
    ("order_id", StringType()), ("order_date", DateType()), ("order_status", StringType()),
    ("fulfilment_type", StringType()), ("sales_channel", StringType()), ("sku", StringType()),
    ("category", StringType()), ("size", StringType()), ("quantity", IntegerType()),
    ("amount", MONEY), ("currency", StringType()), ("ship_city", StringType()),
    ("ship_state", StringType()), ("ship_postal_code", StringType()),
    ("ship_country", StringType()), ("is_b2b", BooleanType()),
    ("loaded_timestamp", TimestampNTZType()),
)

STG_INTERNATIONAL_SALES = _s(
    ("transaction_id", StringType()), ("order_date", DateType()), ("month_year", StringType()),
    ("customer_name", StringType()), ("style", StringType()), ("sku", StringType()),
    ("size", StringType()), ("quantity", IntegerType()), ("unit_price", MONEY),
    ("gross_amount", MONEY), ("loaded_timestamp", TimestampNTZType()),
)

STG_STOCK_LEVELS = _s(
    ("sku_code", StringType()), ("design_number", StringType()), ("stock_quantity", IntegerType()),
    ("category", StringType()), ("size", StringType()), ("color", StringType()),
    ("loaded_timestamp", TimestampNTZType()),
)

DIM_CUSTOMERS = _s(
    ("customer_id", StringType()), ("customer_name", StringType()), ("amazon_order_id", StringType()),
    ("city", StringType()), ("state", StringType()), ("country", StringType()),
    ("is_business_customer", BooleanType()), ("source_system", StringType()),
)

DIM_PRODUCTS = _s(
    ("product_sku", StringType()), ("design_number", StringType()), ("product_category", StringType()),
    ("style", StringType()), ("size", StringType()), ("color", StringType()),
    ("stock_category", StringType()), ("updated_timestamp", TimestampNTZType()),
)

FCT_INVENTORY = _s(
    ("product_sku", StringType()), ("stock_quantity", IntegerType()), ("category", StringType()),
    ("size", StringType()), ("color", StringType()), ("snapshot_date", TimestampNTZType()),
    ("previous_stock_quantity", IntegerType()), ("stock_change", IntegerType()),
    ("stock_status", StringType()), ("reorder_suggestion", StringType()),
)

FCT_SALES = _s(
    ("sales_id", StringType()), ("order_date", DateType()), ("order_status", StringType()),
    ("product_sku", StringType()), ("product_category", StringType()), ("size", StringType()),
    ("color", StringType()), ("quantity", IntegerType()), ("amount", MONEY),
    ("unit_price", DoubleType()), ("currency", StringType()), ("ship_city", StringType()),
    ("ship_state", StringType()), ("ship_country", StringType()), ("is_b2b", BooleanType()),
    ("sales_channel", StringType()), ("gross_revenue", MONEY), ("gross_revenue_inr", MONEY_INR),
    ("order_year", IntegerType()), ("order_month", IntegerType()), ("order_year_month", StringType()),
)

INVENTORY_ANALYSIS = _s(
    ("product_sku", StringType()), ("category", StringType()), ("size", StringType()),
    ("color", StringType()), ("stock_quantity", IntegerType()), ("stock_status", StringType()),
    ("reorder_suggestion", StringType()), ("snapshot_date", TimestampNTZType()),
    ("units_sold_30days", LongType()), ("daily_sales_rate", DoubleType()),
    ("days_of_inventory", DoubleType()), ("avg_weekly_stock_change", DoubleType()),
    ("inventory_action_required", StringType()), ("suggested_reorder_quantity", LongType()),
)

SALES_SUMMARY_BY_PRODUCT = _s(
    ("product_sku", StringType()), ("product_category", StringType()), ("size", StringType()),
    ("color", StringType()), ("sales_channel", StringType()), ("total_transactions", LongType()),
    ("total_units_sold", LongType()), ("total_revenue_inr", DoubleType()),
    ("avg_selling_price", DoubleType()), ("active_months", LongType()),
    ("first_sale_date", DateType()), ("last_sale_date", DateType()),
    ("avg_order_value", DoubleType()), ("revenue_rank", LongType()), ("volume_rank", LongType()),
    ("revenue_tier", StringType()),
)

SALES_SUMMARY_BY_REGION = _s(
    ("ship_state", StringType()), ("ship_city", StringType()), ("ship_country", StringType()),
    ("sales_channel", StringType()), ("total_orders", LongType()), ("total_units", LongType()),
    ("total_revenue_inr", DoubleType()), ("avg_price", DoubleType()), ("b2b_revenue", DoubleType()),
    ("b2c_revenue", DoubleType()), ("b2b_percentage", DoubleType()),
    ("revenue_share_percentage", DoubleType()), ("state_rank", LongType()),
)

QUALITY_RESULT = _s(
    ("layer", StringType()), ("table_name", StringType()), ("check_name", StringType()),
    ("status", StringType()), ("violations", LongType()), ("checked_rows", LongType()),
)

MODEL_SCHEMAS = {
    "stg_amazon_sales": STG_AMAZON_SALES,
    "stg_international_sales": STG_INTERNATIONAL_SALES,
    "stg_stock_levels": STG_STOCK_LEVELS,
    "dim_customers": DIM_CUSTOMERS,
    "dim_products": DIM_PRODUCTS,
    "fct_inventory": FCT_INVENTORY,
    "fct_sales": FCT_SALES,
    "inventory_analysis": INVENTORY_ANALYSIS,
    "sales_summary_by_product": SALES_SUMMARY_BY_PRODUCT,
    "sales_summary_by_region": SALES_SUMMARY_BY_REGION,
}


def conform(df, schema: StructType):
    """Select the contract columns in contract order, cast to contract types."""
    return df.selectExpr(*[f"CAST({q(f.name)} AS {f.dataType.simpleString()}) AS {q(f.name)}"
                           for f in schema.fields])
