"""Table sinks (S4), view sink (S5) and the append-only stock history.

``CheckpointSink`` writes parquet under the session's shared checkpoint
folder (query runs); ``CatalogSink`` writes managed tables, published in one database
per layer (pipeline runs). Both hand back a fresh scan of what was written,
so downstream plans start at the table and lineage is cut.

Published names are views over versions. A model is written aside as a version of its own
(``<layer>_versions.<name>__<version>``), its checks read that version, and ``publish`` then points
the public view at it: one catalog switch a model. What fails its checks, or stops half-way, is never
public; readers go on with the version before, which is kept until the next publication.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from retail_lake.session import ensure_checkpoint_dir

LAYER_OF = {
    "raw_amazon_sales": "bronze", "raw_international_sales": "bronze", "raw_stock_levels": "bronze",
    "stg_amazon_sales": "bronze", "stg_international_sales": "bronze", "stg_stock_levels": "bronze",
    "stg_stock_history": "bronze",
    "dim_customers": "silver", "dim_products": "silver", "fct_inventory": "silver", "fct_sales": "silver",
    "inventory_analysis": "gold", "sales_summary_by_product": "gold", "sales_summary_by_region": "gold",
    "quality_results": "ops", "run_log": "ops", "model_commits": "ops", "data_dictionary": "ops",
}


HISTORY_TABLES = {"stg_stock_history"}      # append-only: never written as a full refresh
#: Tables laid out by a column that readers filter on: a folder for each of its values.
PARTITIONED_BY = {"fct_sales": "order_year_month"}


def base_name(name: str) -> str:
    for variant in ("_resolved", "_one_per_sku", "_reference"):
        name = name.removesuffix(variant)
    return name


def layer_of(name: str) -> str:
    return LAYER_OF.get(base_name(name), "silver")


def laid_out(name: str, df: DataFrame) -> DataFrameWriter:
    """Writer of a table in its layout.

    The rows of a partition meet before they are written, so the number of files follows the bytes and not
    tasks x partitions. A rebalance, not a repartition: Spark splits a value with many rows over several tasks
    (and files) and gives small values one task together, by the sizes it measures.
    """
    column = PARTITIONED_BY.get(base_name(name))
    return df.write if column is None else df.hint("rebalance", column).write.partitionBy(column)


class CheckpointSink:
    """Parquet files under ``spark.checkpoint.dir`` (read from the session)."""

    def __init__(self, spark: SparkSession, prefix: str):
        self.spark, self.uid = spark, uuid.uuid4().hex
        self.root = ensure_checkpoint_dir(spark).rstrip("/") + f"/retail_lake/{prefix}"

    def write(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        laid_out(name, df).mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


class CatalogSink:
    """Versioned managed tables, full refresh, published by views of one database per layer.

    ``prefix`` stands before the databases' names, so that several lakes share a catalog.
    """

    def __init__(self, spark: SparkSession, fmt: str = "parquet", location: str | None = None, prefix: str = ""):
        self.spark, self.fmt, self.location, self.prefix = spark, fmt, location, prefix
        self.uid = uuid.uuid4().hex        # one run: its models are built once, never reused by another run
        self.version = f"{dt.datetime.now():%Y%m%d%H%M%S%f}_{self.uid[:6]}"      # sorts by time
        self.unpublished: dict[str, str] = {}

    def _create(self, db: str) -> str:
        db = self.prefix + db
        where = f" LOCATION '{self.location.rstrip('/')}/{db}.db'" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{where}")
        return db

    def database(self, name: str) -> str:
        return self._create(layer_of(name))

    def table(self, name: str) -> DataFrame:
        """A table published by an earlier run."""
        return self.spark.table(f"{self.database(name)}.{name}")

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database(name)}.{name}")

    def append(self, name: str, df: DataFrame) -> DataFrame:
        table = f"{self.database(name)}.{name}"
        df.write.mode("append").format(self.fmt).saveAsTable(table)
        return self.spark.table(table)

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write a version aside and read it back; it is public from ``publish`` on."""
        if name in HISTORY_TABLES:
            raise ValueError(f"{name} is append-only and cannot be refreshed")
        table = f"{self._create(layer_of(name) + '_versions')}.{name}__{self.version}"
        laid_out(name, df).mode("overwrite").format(self.fmt).saveAsTable(table)
        self.unpublished[name] = table
        return self.spark.table(table)

    def written_as(self, name: str) -> str:
        """The table that holds the name's rows of this run."""
        return self.unpublished.get(name) or f"{self.database(name)}.{name}"

    def adopt(self, name: str, table: str) -> DataFrame:
        """Take a version that an earlier attempt of this run wrote; it is public from ``publish`` on."""
        if name not in HISTORY_TABLES:
            self.unpublished[name] = table
        return self.spark.table(table)

    def publish(self) -> list[str]:
        """Point the public names at the versions written since the last call; returns those names."""
        names = list(self.unpublished)
        for name in names:
            table, public = self.unpublished.pop(name), f"{self.database(name)}.{name}"
            before = None
            if self.spark.catalog.tableExists(public):
                if self.spark.catalog.getTable(public).tableType == "VIEW":
                    rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {public}").where("col_name = 'View Text'").collect()
                    before = rows[0].data_type.split(" FROM ")[-1].strip() if rows else None
                else:
                    self.spark.sql(f"DROP TABLE {public}")   # of the layout before versions
            if before == table:                  # published by an earlier attempt
                continue
            self.spark.sql(f"CREATE OR REPLACE VIEW {public} AS SELECT * FROM {table}")
            self._drop_older(name, table, before)
        return names

    def _drop_older(self, name: str, current: str, before: str | None) -> None:
        """Older versions of the name, but for the one that was public until now: running readers may hold it."""
        db, kept = current.split(".")
        for t in self.spark.catalog.listTables(db):
            if t.name.rpartition("__")[0] == name and t.name < kept and f"{db}.{t.name}" != before:
                self.spark.sql(f"DROP TABLE IF EXISTS {db}.{t.name}")

    def append_partition(self, name: str, df: DataFrame, partition_col: str) -> DataFrame:
        """Append-only history: replace only the partitions present in ``df``.

        Re-running a load with the same load time rewrites that load's
        partition and nothing else (dynamic partition overwrite), so the
        append is idempotent.
        """
        table = f"{self.database(name)}.{name}"
        if not self.spark.catalog.tableExists(table):
            df.write.format(self.fmt).partitionBy(partition_col).saveAsTable(table)
        else:
            cols = self.spark.table(table).columns
            # set on the frame's own session: inside foreachBatch that is the
            # stream's cloned session, not the one this sink was made with
            conf = df.sparkSession.conf
            key = "spark.sql.sources.partitionOverwriteMode"
            before = conf.get(key)
            conf.set(key, "dynamic")
            try:
                df.select(*cols).write.insertInto(table, overwrite=True)
            finally:
                conf.set(key, before)
        return self.spark.table(table)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """View sink: a session view over the plan, nothing written (S5)."""
    df.createOrReplaceTempView(name)
    return df
