"""Seed files: raw CSV -> DataFrame with the declared raw schema (S1).

Columns are matched by header name (white space around it aside), as the
reference's seeds are: order does not matter, further columns are ignored, a
missing one is an error. Values are
read as text and cast to the declared types; ``malformed_values`` counts, per
column, the values that are there but do not cast (they become NULL); the
layer runner records them with its checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lake.functions.sql import q, s
from retail_lake.schemas import RAW_SCHEMAS


def _read_text(spark: SparkSession, table: str, path: str) -> DataFrame:
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    own = {c.strip(): c for c in df.columns}
    names = [f.name for f in RAW_SCHEMAS[table].fields]
    missing = [n for n in names if n.strip() not in own]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing} of {table}")
    return df.selectExpr(*[f"{q(own[n.strip()])} AS {q(n)}" for n in names])


def _cast(field) -> str:
    return f"try_cast({q(field.name)} AS {field.dataType.simpleString()})"


def read_seed(spark: SparkSession, table: str, path: str) -> DataFrame:
    fields = RAW_SCHEMAS[table].fields
    return _read_text(spark, table, path).selectExpr(*[f"{_cast(f)} AS {q(f.name)}" for f in fields])


def read_seeds(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    return {table: read_seed(spark, table, path) for table, path in paths.items()}


def malformed_values(spark: SparkSession, table: str, path: str) -> DataFrame:
    """(table_name, column_name, data_type, malformed, present): one pass over the file."""
    fields = RAW_SCHEMAS[table].fields
    counts = _read_text(spark, table, path).agg(*[
        F.expr(e).alias(f"{n}{i}") for i, f in enumerate(fields)
        for n, e in (("n", f"count_if({q(f.name)} IS NOT NULL AND {_cast(f)} IS NULL)"), ("p", f"count({q(f.name)})"))])
    rows = ", ".join(f"{s(f.name)}, {s(f.dataType.simpleString())}, n{i}, p{i}" for i, f in enumerate(fields))
    return counts.selectExpr(f"{s(table)} AS table_name",
                             f"stack({len(fields)}, {rows}) AS (column_name, data_type, malformed, present)")
