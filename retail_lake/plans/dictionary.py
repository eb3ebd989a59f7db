"""Data dictionary: per table and column the type, rows, NULLs, distinct
values, min and max, as a DataFrame (re-aims the reference's docs step).

One aggregate per table counts rows and the values that are there; ``stack``
turns the wide row into one row per column. Distinct counts are exact: every
column is read once more on its own (the files are columnar, so all of these
together read a table once), its values are reduced to distinct ones in their
own type map-side, and these are counted and give min and max. No row is turned
into pairs of text, and no text of every row is compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from retail_lake.functions.sql import q, s

DICTIONARY_TABLES = ["dim_customers_resolved", "dim_products_one_per_sku", "fct_sales_one_per_sku",
                     "fct_inventory"]


def _text(field, agg: str) -> str:
    """Aggregate of the values as text; floating values go through a fixed-scale decimal."""
    if isinstance(field.dataType, (DoubleType, FloatType)):
        return f"CAST(CAST({agg}(value) AS DECIMAL(38,6)) AS STRING)"
    return f"CAST({agg}(value) AS STRING)"


def _value(field) -> str:
    """The column's value (the two zeros of floating types are one value)."""
    c = q(field.name)
    return f"CASE WHEN {c} = 0 THEN abs({c}) ELSE {c} END" if isinstance(field.dataType, (DoubleType, FloatType)) else c


def _key(field) -> str:
    """Text that is equal exactly where values are."""
    return f"CAST({_value(field)} AS STRING)"


def profile(df: DataFrame, table: str) -> DataFrame:
    fields = df.schema.fields
    wide = df.agg(F.expr("count(*) AS __rows"), *[F.expr(f"count({q(f.name)}) AS n{i}") for i, f in enumerate(fields)])
    rows = ", ".join(f"{s(f.name)}, {s(f.dataType.simpleString())}, __rows - n{i}" for i, f in enumerate(fields))
    columns = wide.selectExpr("__rows AS row_count", f"stack({len(fields)}, {rows}) AS (name, data_type, null_count)")
    values = reduce(DataFrame.unionByName, [
        df.selectExpr(f"{_value(f)} AS value").where("value IS NOT NULL").distinct()
          .agg(F.expr("count(*) AS distinct_count"), F.expr(f"{_text(f, 'min')} AS min_value"),
               F.expr(f"{_text(f, 'max')} AS max_value"))
          .selectExpr(f"{s(f.name)} AS column_name", "distinct_count", "min_value", "max_value")
        for f in fields])
    return columns.join(values, F.expr("name = column_name"), "left").selectExpr(
        f"{s(table)} AS table_name", "row_count", "name AS column_name", "data_type", "null_count",
        "coalesce(distinct_count, 0) AS distinct_count", "min_value", "max_value")


def data_dictionary(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [profile(df, name) for name, df in tables.items()])
