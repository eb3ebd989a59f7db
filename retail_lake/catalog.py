"""Registry of queries: key -> (Spark builder over a Lake, oracle SQL text).

Queries read the folder's whole tables, but for queries on one sales channel,
which read that channel's order lines (see sources/fixtures.py); keys without
an oracle statement are checked against brute force in tests/.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lake import oracle
from retail_lake.lake import Lake


@dataclass(frozen=True)
class Query:
    build: Callable[[Lake], DataFrame]
    sql: str | None
    covers: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, build: Callable[[Lake], DataFrame], sql: str | None, covers: str = "") -> None:
    if name in REGISTRY:
        raise ValueError(f"duplicate query {name}")
    REGISTRY[name] = Query(build, sql, covers)


# ----------------------------------------------------------------- models
register("stg_amazon_sales", lambda lake: lake.stg_amazon_sales, oracle.model_sql("stg_amazon_sales"), "M1")
register("stg_international_sales", lambda lake: lake.stg_international_sales,
         oracle.model_sql("stg_international_sales"), "M2")
register("stg_stock_levels", lambda lake: lake.stg_stock_levels, oracle.model_sql("stg_stock_levels"), "M3")
register("dim_customers", lambda lake: lake.dim_customers(), oracle.model_sql("dim_customers"), "M4")
register("dim_customers_resolved", lambda lake: lake.dim_customers(resolved=True),
         oracle.model_sql("dim_customers_resolved"), "M4 D8")
register("dim_products", lambda lake: lake.dim_products(), oracle.model_sql("dim_products"), "M5")
register("dim_products_one_per_sku", lambda lake: lake.dim_products(one_row_per_sku=True),
         oracle.model_sql("dim_products_one_per_sku"), "M5 D7")
register("fct_inventory", lambda lake: lake.fct_inventory, oracle.model_sql("fct_inventory"), "M6")
register("fct_sales", lambda lake: lake.fct_sales(), oracle.model_sql("fct_sales"), "M7")
register("fct_sales_one_per_sku", lambda lake: lake.fct_sales(one_row_per_sku=True),
         oracle.model_sql("fct_sales_one_per_sku"), "M7 D7")
register("inventory_analysis", lambda lake: lake.inventory_analysis(), oracle.gold_sql("inventory_analysis"), "M8")
register("sales_summary_by_product", lambda lake: lake.sales_summary_by_product(),
         oracle.gold_sql("sales_summary_by_product"), "M9")
register("sales_summary_by_region", lambda lake: lake.sales_summary_by_region(),
         oracle.gold_sql("sales_summary_by_region"), "M10")
register("sales_summary_by_product_one_per_sku", lambda lake: lake.sales_summary_by_product(one_row_per_sku=True),
         oracle.gold_sql("sales_summary_by_product", "one_per_sku"), "M9 D7")
register("sales_summary_by_region_one_per_sku", lambda lake: lake.sales_summary_by_region(one_row_per_sku=True),
         oracle.gold_sql("sales_summary_by_region", "one_per_sku"), "M10 D7")
register("inventory_analysis_one_per_sku", lambda lake: lake.inventory_analysis(one_row_per_sku=True),
         oracle.gold_sql("inventory_analysis", "one_per_sku"), "M8 D7")

# ------------------------------------------- models refreshed load by load
from retail_lake.plans import incremental as _incremental  # noqa: E402

register("fct_inventory_by_loads", lambda lake: _incremental.inventory_by_loads(lake.stg_stock_history),
         oracle.stock_windows_sql(), "M6 W1-W3 D12")
register("sales_summary_by_product_by_loads", lambda lake: _incremental.product_summary_by_loads(lake.fct_sales_once()),
         oracle.gold_sql("sales_summary_by_product"), "M9")
register("sales_summary_by_region_by_loads", lambda lake: _incremental.region_summary_by_loads(lake.fct_sales_once()),
         oracle.gold_sql("sales_summary_by_region"), "M10")


# -------------------------------------------------------------- operators
from retail_lake.plans.operator_queries import OPERATOR_QUERIES  # noqa: E402

for _name, (_fn, _covers) in OPERATOR_QUERIES.items():
    register(_name, _fn, oracle.OPERATOR_SQL[_name], _covers)


# ---------------------------------------------------------------- quality
from retail_lake.plans import quality as _quality  # noqa: E402
from retail_lake.plans.dictionary import DICTIONARY_TABLES, data_dictionary  # noqa: E402

_QUALITY_SQL = oracle.quality_sql()
for _name, (_checks, _covers) in _quality.QUALITY_QUERIES.items():
    register(_name, lambda lake, _checks=_checks: _quality.run_checks(lake, _checks()),
             _QUALITY_SQL[_name], _covers)


# ------------------------------------------------------------ layer runner
from retail_lake.plans import pipeline as _pipeline  # noqa: E402

register("layer_run", _pipeline.layer_run, oracle.layer_run_sql(), "S4 L1-L3")


# ---------------------------------------------------------- landed files
from retail_lake.plans import quarantine as _quarantine  # noqa: E402


def _landed(lake: Lake) -> dict[str, DataFrame]:
    return {t: getattr(lake, t) for t in _quarantine.REQUIRED}


register("quarantined_rows", lambda lake: _quarantine.quarantined_rows(_landed(lake)), oracle.quarantine_sql(), "Q4 F1")
register("dq_schema_validation", lambda lake: _quarantine.schema_validation(_landed(lake)),
         oracle.schema_validation_sql(), "Q3")


def _dictionary(lake: Lake) -> DataFrame:
    return data_dictionary({t: _quality.model_table(lake, t) for t in DICTIONARY_TABLES})


register("data_dictionary", _dictionary, oracle.dictionary_sql(), "L4")

from retail_lake.plans import sketches as _sketches  # noqa: E402

register("dictionary_sketches", _sketches.dictionary_sketches, oracle.dictionary_sketches_sql(), "L4")


# Money columns are DECIMAL in the stored tables; query results expose them as
# DOUBLE on both sides so a result compares the same whichever client reads
# it (the decimal -> double conversion is exact rounding in both engines).
DECIMAL_OUTPUTS = {
    "stg_amazon_sales": ["amount"],
    "stg_international_sales": ["unit_price", "gross_amount"],
    "fct_sales": ["amount", "gross_revenue", "gross_revenue_inr"],
    "fct_sales_one_per_sku": ["amount", "gross_revenue", "gross_revenue_inr"],
    "numeric_boolean_defaults": ["raw_amount", "amount", "raw_unit_price", "unit_price"],
    "channel_union": ["amount"],
    "currency_to_inr": ["amount", "gross_revenue_inr"],
}


def as_double(df: DataFrame) -> DataFrame:
    from pyspark.sql.types import DecimalType
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(name: str, q: Query):
        if name in DECIMAL_OUTPUTS:
            return lambda spark, sf_dir: as_double(q.build(Lake(spark, sf_dir)))
        return lambda spark, sf_dir: q.build(Lake(spark, sf_dir))
    return {name: bind(name, q) for name, q in REGISTRY.items()}


def oracle_statements() -> dict[str, str]:
    out = {}
    for name, q in REGISTRY.items():
        if q.sql is None:
            continue
        cols = DECIMAL_OUTPUTS.get(name)
        if cols:
            casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
            out[name] = f"SELECT * REPLACE ({casts}) FROM ({q.sql}) q"
        else:
            out[name] = q.sql
    return out
