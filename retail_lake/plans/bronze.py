"""Bronze layer: typed, trimmed, defaulted copies of the raw files (M1-M3).

Each model is one projection plus one required-key filter; Catalyst fuses them
into a single codegen stage and pushes the key filter below the projection.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from retail_lake.functions.cleaning import (
    DEFAULT_CURRENCY, UNKNOWN, clamp_count, clean_text, flag_or_false, number_or_zero,
    parse_dmy, text_or_default, transaction_key,
)
from retail_lake.functions.sql import q
from retail_lake.schemas import STG_AMAZON_SALES, STG_INTERNATIONAL_SALES, STG_STOCK_LEVELS, conform


def load_time(load_ts) -> str:
    """Load-time stamp: a literal datetime, or the name of a column on the rows."""
    if isinstance(load_ts, str):
        return f"CAST({q(load_ts)} AS TIMESTAMP_NTZ)"
    if isinstance(load_ts, dt.datetime):
        return f"TIMESTAMP_NTZ '{load_ts.isoformat(sep=' ')}'"
    raise TypeError(f"unsupported load_ts {load_ts!r}")


def stg_amazon_sales(raw: DataFrame, load_ts) -> DataFrame:
    out = raw.selectExpr(
        f"{clean_text('Order ID')} AS order_id",
        f"{parse_dmy('Date')} AS order_date",
        f"{text_or_default('Status')} AS order_status",
        f"{clean_text('Fulfilment')} AS fulfilment_type",
        f"{clean_text('Sales Channel ')} AS sales_channel",
        f"{text_or_default('SKU')} AS sku",
        f"{clean_text('Category')} AS category",
        f"{clean_text('Size')} AS size",
        f"{clamp_count('Qty', 0)} AS quantity",
        f"{number_or_zero('Amount')} AS amount",
        f"{text_or_default('currency', DEFAULT_CURRENCY)} AS currency",
        f"{clean_text('ship-city')} AS ship_city",
        f"{clean_text('ship-state')} AS ship_state",
        f"{q('ship-postal-code')} AS ship_postal_code",
        f"{clean_text('ship-country')} AS ship_country",
        f"{flag_or_false('B2B')} AS is_b2b",
        f"{load_time(load_ts)} AS loaded_timestamp",
    )
    return conform(out.where("order_id IS NOT NULL"), STG_AMAZON_SALES)


def stg_international_sales(raw: DataFrame, load_ts) -> DataFrame:
    out = raw.selectExpr(
        f"{transaction_key('CUSTOMER', 'SKU', 'DATE')} AS transaction_id",
        f"{parse_dmy('DATE')} AS order_date",
        f"{clean_text('Months')} AS month_year",
        f"{text_or_default('CUSTOMER', UNKNOWN)} AS customer_name",
        f"{clean_text('Style')} AS style",
        f"{clean_text('SKU')} AS sku",
        f"{clean_text('Size')} AS size",
        f"{clamp_count('PCS', 1)} AS quantity",
        f"{number_or_zero('RATE')} AS unit_price",
        f"{number_or_zero('GROSS AMT')} AS gross_amount",
        f"{load_time(load_ts)} AS loaded_timestamp",
    )
    return conform(out.where("sku IS NOT NULL"), STG_INTERNATIONAL_SALES)


def stg_stock_levels(raw: DataFrame, load_ts="loaded_timestamp") -> DataFrame:
    """Stock file of one load, or many loads when ``load_ts`` names a column.

    Passing the snapshot files with their own ``loaded_timestamp`` column gives
    the append-only stock history that the inventory windows need.
    """
    out = raw.selectExpr(
        f"{clean_text('SKU Code')} AS sku_code",
        f"{clean_text('Design No.')} AS design_number",
        f"{clamp_count('Stock', 0)} AS stock_quantity",
        f"{text_or_default('Category')} AS category",
        f"{text_or_default('Size')} AS size",
        f"{text_or_default('Color')} AS color",
        f"{load_time(load_ts)} AS loaded_timestamp",
    )
    return conform(out.where("sku_code IS NOT NULL"), STG_STOCK_LEVELS)
