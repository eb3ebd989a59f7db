"""Row-level quarantine of landed files, and their columns against the declared schema (Q3, Q4).

A landed file is text in every column. One pass gives each row the list of what is wrong with it: the key that
bronze requires is missing, a value is there but does not convert to the declared type, or a date is
not one. ``split`` writes the pass once, partitioned by whether a row is quarantined, so that the
staged and the quarantined rows are two pruned scans of one table and together are the file. Rows keep
their landed text in quarantine: after a repair at the source they are landed again.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.functions.cleaning import clean_text, dmy_castable
from retail_lake.functions.sql import q, s
from retail_lake.operators.stages import folders_unsorted
from retail_lake.schemas import RAW_SCHEMAS
from retail_lake.session import ensure_checkpoint_dir

# The column each bronze model requires, and the columns that hold DD-MM-YY dates.
REQUIRED = {"raw_amazon_sales": "Order ID", "raw_international_sales": "SKU", "raw_stock_levels": "SKU Code"}
DATES = {"raw_amazon_sales": "Date", "raw_international_sales": "DATE"}
REASONS, FLAG = "quarantine_reasons", "quarantined"


def expected_type(table: str, field) -> str:
    return "date (DD-MM-YY)" if DATES.get(table) == field.name else field.dataType.simpleString()


def malformed(table: str, field) -> str:
    """True where a landed value is there but is not of the declared type."""
    if DATES.get(table) == field.name:
        return f"(NOT {dmy_castable(field.name)})"
    return f"({q(field.name)} IS NOT NULL AND try_cast({q(field.name)} AS {field.dataType.simpleString()}) IS NULL)"


def as_landed(table: str, raw: DataFrame) -> DataFrame:
    """The file's declared columns as text."""
    return raw.selectExpr(*[f"CAST({q(f.name)} AS STRING) AS {q(f.name)}" for f in RAW_SCHEMAS[table].fields])


def judged(table: str, landed: DataFrame) -> DataFrame:
    """``landed`` with the reasons of every row: an empty list for a row that may be staged."""
    fields, key = RAW_SCHEMAS[table].fields, REQUIRED[table]
    found = [f"IF({clean_text(key)} IS NULL, {s(f'{key}: missing')}, NULL)"]
    found += [f"IF({malformed(table, f)}, {s(f'{f.name}: not {expected_type(table, f)}')}, NULL)"
              for f in fields if f.dataType.simpleString() != "string" or DATES.get(table) == f.name]
    return landed.selectExpr("*", f"array_compact(array({', '.join(found)})) AS {REASONS}")


def split(table: str, landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(staged rows in the declared types, quarantined rows as text with their reasons); one pass over the file."""
    spark = landed.sparkSession
    rows = judged(table, landed).withColumn(FLAG, F.expr(f"IF(size({REASONS}) > 0, 1, 0)"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/retail_lake/landed/{table}-{uuid.uuid4().hex}"
    with folders_unsorted(spark):
        rows.write.partitionBy(FLAG).parquet(path)
    written = spark.read.schema(rows.schema).parquet(path)
    staged = written.where(f"{FLAG} = 0").selectExpr(
        *[f"CAST({q(f.name)} AS {f.dataType.simpleString()}) AS {q(f.name)}" for f in RAW_SCHEMAS[table].fields])
    return staged, written.where(f"{FLAG} = 1").drop(FLAG)


def rejected(table: str, quarantined: DataFrame) -> DataFrame:
    """Quarantined rows of any file in one shape: table, key, reasons, the landed columns joined by ``|``."""
    text = ", ".join(f"coalesce({q(f.name)}, '')" for f in RAW_SCHEMAS[table].fields)
    return quarantined.selectExpr(f"{s(table)} AS table_name", f"{q(REQUIRED[table])} AS row_key",
                                  f"array_join({REASONS}, '; ') AS reasons", f"concat_ws('|', {text}) AS payload")


def quarantined_rows(raw: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [rejected(t, split(t, as_landed(t, df))[1]) for t, df in raw.items()])


def column_checks(table: str, landed: DataFrame) -> DataFrame:
    """Every declared column of a file: rows, values present and malformed, status; one aggregate of one scan.

    A column that the file lacks is ``missing`` (names are compared as they are written), one with a
    malformed value is ``failed``.
    """
    fields = RAW_SCHEMAS[table].fields
    here = [f.name in landed.columns for f in fields]
    counts = landed.agg(F.count(F.lit(1)).alias("n"), *[
        F.expr(e if there else "0L").alias(f"{kind}{i}") for i, (f, there) in enumerate(zip(fields, here, strict=True))
        for kind, e in (("p", f"count({q(f.name)})"), ("m", f"count_if({malformed(table, f)})"))])
    rows = ", ".join(f"{s(f.name)}, {s(expected_type(table, f))}, {'true' if there else 'false'}, p{i}, m{i}"
                     for i, (f, there) in enumerate(zip(fields, here, strict=True)))
    return counts.selectExpr("n", f"stack({len(fields)}, {rows}) AS (column_name, expected_type, here, present, malformed)") \
        .selectExpr(f"{s(table)} AS table_name", "column_name", "expected_type", "n AS checked_rows", "present", "malformed",
                    "CASE WHEN NOT here THEN 'missing' WHEN malformed > 0 THEN 'failed' ELSE 'passed' END AS status")


def schema_validation(raw: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [column_checks(t, as_landed(t, df)) for t, df in raw.items()])
