"""Mergeable column sketches, kept per table and load: a dictionary that reads new loads only.

A load is sketched in one scan: rows and NULLs as sums, distinct values as a HyperLogLog sketch, numeric values
as a KLL quantile sketch (Spark's own aggregates, partial before the shuffle; no distinct value is shuffled).
A store keeps one folder for each table and load; a load that is sketched again replaces itself. The
dictionary merges what is kept, a few rows for each load and column, and no table is read for it.

Stated bounds: distinct counts within ``DISTINCT_BOUND`` of the exact count (four standard errors), quantiles
within ``RANK_BOUND`` of their rank. The exact dictionary (plans/dictionary.py) stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from retail_lake.functions.sql import q, s
from retail_lake.lake import Lake
from retail_lake.plans.dictionary import DICTIONARY_TABLES, _key, data_dictionary
from retail_lake.plans.quality import model_table
from retail_lake.session import ensure_checkpoint_dir

LG_K = 12                                    # 4,096 registers, about 4 KB a column and load
DISTINCT_BOUND = 4 * 1.04 / 2 ** (LG_K / 2)
KLL_K = 200
RANK_BOUND = 0.02
STORE_SCHEMA = ("column_name string, position int, data_type string, row_count bigint, null_count bigint, "
                "distinct_sketch binary, value_sketch binary, table_name string, load string")
#: What a load of a table is; the dimensions are written whole by every run.
LOADS = {"fct_sales_one_per_sku": "order_year_month", "fct_inventory": "CAST(snapshot_date AS STRING)"}
WHOLE = "'whole'"


def load_sketches(df: DataFrame, load: str = WHOLE) -> DataFrame:
    """(column_name, position, data_type, row_count, null_count, distinct_sketch, value_sketch, load) of every load.

    ``load``: SQL expression of a row's load. Rows with a NULL load form a load of their own.
    """
    fields = df.schema.fields
    aggs, rows = ["count(*) AS __rows"], []
    for i, f in enumerate(fields):
        # a sign before the text: the sketch passes over empty strings
        aggs += [f"count({q(f.name)}) AS n{i}", f"hll_sketch_agg(concat('=', {_key(f)}), {LG_K}) AS h{i}"]
        values = "CAST(NULL AS BINARY)"
        if isinstance(f.dataType, NumericType):
            aggs.append(f"kll_sketch_agg_double(CAST({q(f.name)} AS DOUBLE), {KLL_K}) AS k{i}")
            values = f"k{i}"
        rows.append(f"{s(f.name)}, {i}, {s(f.dataType.simpleString())}, __rows - n{i}, h{i}, {values}")
    wide = df.groupBy(F.expr(load).alias("__load")).agg(*[F.expr(a) for a in aggs])
    names = "column_name, position, data_type, null_count, distinct_sketch, value_sketch"
    return wide.selectExpr("__load", "__rows AS row_count", f"stack({len(fields)}, {', '.join(rows)}) AS ({names})") \
               .selectExpr("column_name", "position", "data_type", "row_count", "null_count", "distinct_sketch",
                           "value_sketch", "__load AS load")


class SketchStore:
    """Sketches under a folder, partitioned by table and load."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, table: str, df: DataFrame, load: str = WHOLE) -> None:
        """Sketch the loads in ``df``; each replaces what the store has of it."""
        (load_sketches(df, load).withColumn("table_name", F.lit(table))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("table_name", "load").parquet(self.path))

    def read(self) -> DataFrame:
        return self.spark.read.schema(STORE_SCHEMA).parquet(self.path)


def merged_dictionary(sketches: DataFrame) -> DataFrame:
    """Per table and column: rows, NULLs, estimated distinct values and quartiles (NULL where no number is)."""
    merged = sketches.groupBy("table_name", "column_name", "data_type").agg(
        F.min("position").alias("position"), F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.expr("hll_sketch_estimate(hll_union_agg(distinct_sketch)) AS distinct_estimate"),
        F.expr("kll_merge_agg_double(value_sketch) AS __values"))
    quartile = "CASE WHEN kll_sketch_get_n_double(__values) > 0 THEN kll_sketch_get_quantile_double(__values, {}) END"
    return merged.selectExpr("table_name", "column_name", "data_type", "position", "row_count", "null_count",
                             "distinct_estimate", f"{quartile.format('0.25D')} AS quartile_1",
                             f"{quartile.format('0.5D')} AS median", f"{quartile.format('0.75D')} AS quartile_3")


def dictionary_sketches(lake: Lake) -> DataFrame:
    """The merged sketches beside the exact dictionary: sums of the loads, the exact distinct count, and whether
    the estimate keeps its stated bound."""
    root = ensure_checkpoint_dir(lake.spark).rstrip("/")
    store = SketchStore(lake.spark, f"{root}/retail_lake/sketches-{uuid.uuid4().hex}")
    tables = {t: model_table(lake, t) for t in DICTIONARY_TABLES}
    for name, df in tables.items():
        store.add(name, df, LOADS.get(name, WHOLE))
    exact = data_dictionary(tables).select("table_name", "column_name", "distinct_count")
    both = merged_dictionary(store.read()).join(exact, ["table_name", "column_name"])
    return both.selectExpr("table_name", "column_name", "row_count", "null_count", "distinct_count",
                           f"abs(distinct_estimate - distinct_count) <= {DISTINCT_BOUND}D * distinct_count AS within_bound")
