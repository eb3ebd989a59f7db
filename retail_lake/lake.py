"""Build every model of the medallion from one input folder.

``Lake`` wires sources -> bronze -> silver -> gold. As in the reference, where
every model is a table, each model is written once as a parquet table under
the session's shared checkpoint folder (``spark.checkpoint.dir``) and read
back by the models downstream. That keeps every query plan to one model's
worth of operators, lets the parquet reader prune columns and push filters at
each model edge, and cuts lineage: a lost executor never forces recomputation
from the raw inputs. ``materialize=False`` instead returns one lazy plan from
the raw scans to the requested model (used by tests and ``explain``).
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession

from retail_lake.params import FIXTURE_PARAMS, RunParams
from retail_lake.plans import bronze, gold, silver
from retail_lake.sources import fixtures
from retail_lake.sources.sinks import CheckpointSink

_WRITTEN: dict[tuple, DataFrame] = {}
_LOCKS: dict[tuple, threading.RLock] = defaultdict(threading.RLock)     # one per model, so others build meanwhile


class Lake:
    """Models of one run.

    ``sf_dir``: driver folder the fixture raw tables are derived from, or
    ``raw``: raw DataFrames (e.g. read from seed CSVs) by raw table name.
    ``sink``: where models are written (default: parquet under the shared
    checkpoint folder); ``materialize=False`` keeps one lazy plan instead.
    ``corrected``: the unsuffixed dimension/fact accessors return the
    corrected variants (one product row per SKU, resolved customers).
    """

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, params: RunParams = FIXTURE_PARAMS,
                 materialize: bool = True, raw: dict[str, DataFrame] | None = None, sink=None,
                 corrected: bool = False):
        self.spark, self.sf_dir, self.params = spark, sf_dir, params
        self.materialize, self.raw, self.corrected = materialize, dict(raw or {}), corrected
        self._lazy: dict[str, DataFrame] = {}
        token = hashlib.sha1(repr((sf_dir, params, corrected)).encode()).hexdigest()[:12]
        # models of given raw frames or of an explicit sink belong to this Lake or that
        # sink's run; the default sink is shared by every Lake over the same folder
        if raw:
            token = uuid.uuid4().hex[:12]
        self._key = (spark.sparkContext.applicationId, token, getattr(sink, "uid", None))
        self.sink = sink if sink is not None or not materialize else CheckpointSink(spark, token)

    def model(self, name: str, build) -> DataFrame:
        """The model as a DataFrame: read from its written table, writing it first if needed."""
        if not self.materialize:
            if name not in self._lazy:
                self._lazy[name] = build()
            return self._lazy[name]
        key = self._key + (name,)
        with _LOCKS[key]:
            if key not in _WRITTEN:
                _WRITTEN[key] = self.sink.write(name, build())
            return _WRITTEN[key]

    def provide(self, name: str, df: DataFrame) -> None:
        """Use an already written table for a model (e.g. the stock history)."""
        _WRITTEN[self._key + (name,)] = df

    def provided(self, name: str, build) -> DataFrame:
        """A model: the written table if the run has one, else its plan."""
        written = _WRITTEN.get(self._key + (name,))
        return build() if written is None else written

    def _raw(self, name: str, derive) -> DataFrame:
        if name in self.raw:
            return self.raw[name]
        if self.sf_dir is None:
            raise ValueError(f"no input for {name}: give sf_dir or raw[{name!r}]")
        return derive(self.spark, self.sf_dir)

    # ------------------------------------------------------------------ raw
    @property
    def raw_amazon_sales(self) -> DataFrame:
        return self._raw("raw_amazon_sales", fixtures.raw_amazon_sales)

    @property
    def raw_international_sales(self) -> DataFrame:
        return self._raw("raw_international_sales", fixtures.raw_international_sales)

    @property
    def raw_stock_levels(self) -> DataFrame:
        return self._raw("raw_stock_levels", fixtures.raw_stock_levels)

    @property
    def raw_stock_snapshots(self) -> DataFrame:
        return self._raw("raw_stock_snapshots", fixtures.raw_stock_snapshots)

    # --------------------------------------------------------------- bronze
    @property
    def stg_amazon_sales(self) -> DataFrame:
        return self.model("stg_amazon_sales",
                          lambda: bronze.stg_amazon_sales(self.raw_amazon_sales, self.params.load_ts))

    @property
    def stg_international_sales(self) -> DataFrame:
        return self.model("stg_international_sales",
                          lambda: bronze.stg_international_sales(self.raw_international_sales, self.params.load_ts))

    @property
    def stg_stock_levels(self) -> DataFrame:
        return self.model("stg_stock_levels",
                          lambda: bronze.stg_stock_levels(self.raw_stock_levels, self.params.load_ts))

    @property
    def stg_stock_history(self) -> DataFrame:
        return self.model("stg_stock_history",
                          lambda: bronze.stg_stock_levels(self.raw_stock_snapshots, "loaded_timestamp"))

    # --------------------------------------------------------------- silver
    def _suffix(self, flag: bool | None, name: str) -> tuple[bool, str]:
        flag = self.corrected if flag is None else flag
        return flag, ("" if flag == self.corrected else name if flag else "_reference")

    def dim_customers(self, resolved: bool | None = None) -> DataFrame:
        resolved, sfx = self._suffix(resolved, "_resolved")
        return self.model(f"dim_customers{sfx}",
                          lambda: silver.dim_customers(self.stg_amazon_sales, self.stg_international_sales,
                                                       resolved))

    def dim_products(self, one_row_per_sku: bool | None = None) -> DataFrame:
        one_row_per_sku, sfx = self._suffix(one_row_per_sku, "_one_per_sku")
        return self.model(f"dim_products{sfx}",
                          lambda: silver.dim_products(self.stg_stock_levels, self.stg_amazon_sales,
                                                      self.stg_international_sales, self.params.load_ts,
                                                      one_row_per_sku))

    @property
    def fct_inventory(self) -> DataFrame:
        return self.model("fct_inventory", lambda: silver.fct_inventory(self.stg_stock_history))

    def fct_sales(self, one_row_per_sku: bool | None = None) -> DataFrame:
        one_row_per_sku, sfx = self._suffix(one_row_per_sku, "_one_per_sku")
        return self.model(f"fct_sales{sfx}",
                          lambda: silver.fct_sales(self.stg_amazon_sales, self.stg_international_sales,
                                                   self.dim_products(one_row_per_sku), self.params.usd_inr))

    def fct_sales_once(self, one_row_per_sku: bool | None = None) -> DataFrame:
        """The sales fact for a query that reads it once: the written table if the run has one, else its plan over
        the written models below it, so that only the columns and rows the query uses are moved and none is written."""
        one_row_per_sku, sfx = self._suffix(one_row_per_sku, "_one_per_sku")
        return self.provided(f"fct_sales{sfx}",
                             lambda: silver.fct_sales(self.stg_amazon_sales, self.stg_international_sales,
                                                      self.dim_products(one_row_per_sku), self.params.usd_inr))

    # ----------------------------------------------------------------- gold
    def _gold(self, name: str, one_row_per_sku: bool | None, build) -> DataFrame:
        _, sfx = self._suffix(one_row_per_sku, "_one_per_sku")
        return self.provided(name + sfx, build)

    def inventory_analysis(self, one_row_per_sku: bool | None = None, sort: bool = True) -> DataFrame:
        return self._gold("inventory_analysis", one_row_per_sku, lambda: gold.inventory_analysis(
            self.fct_inventory, self.fct_sales_once(one_row_per_sku), self.params.as_of, sort=sort))

    def sales_summary_by_product(self, one_row_per_sku: bool | None = None, sort: bool = True) -> DataFrame:
        return self._gold("sales_summary_by_product", one_row_per_sku,
                          lambda: gold.sales_summary_by_product(self.fct_sales_once(one_row_per_sku), sort))

    def sales_summary_by_region(self, one_row_per_sku: bool | None = None, sort: bool = True) -> DataFrame:
        return self._gold("sales_summary_by_region", one_row_per_sku,
                          lambda: gold.sales_summary_by_region(self.fct_sales_once(one_row_per_sku), sort))
