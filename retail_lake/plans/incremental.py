"""Incremental refresh: each load is met with a small state instead of the whole history.

``StockWindows`` keeps the last rows of every SKU (as many as the widest window
looks back), so a stock load computes its own rows only. ``IncrementalSummary`` keeps a gold
summary's groups as mergeable aggregates (sums, counts, bounds, month bits) and the sale keys
each group has counted, so a sales load reads itself and the state. Both give what
a full rebuild over all loads gives.

Loads are numbered from 0. What a load adds is written to folders of its own, and the last of them is the
commit: a load that failed half-way is run again over its own leavings, and one that is committed
already is left out, so a feed may deliver loads more than once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lake.functions.rules import reorder_suggestion, safe_ratio, stock_status
from retail_lake.functions.sql import q
from retail_lake.operators.aggregates import MONTH_WORDS, month_bits, months_set, with_month_bit
from retail_lake.operators.stages import folders_unsorted, stage
from retail_lake.operators.windows import lag_delta, last_rows, moving_average
from retail_lake.params import MOVING_AVG_ROWS
from retail_lake.plans import gold
from retail_lake.plans.silver import NOT_CANCELLED, SNAPSHOT_ORDER
from retail_lake.schemas import FCT_INVENTORY
from retail_lake.session import ensure_checkpoint_dir


class LoadFolders:
    """Folders of numbered loads under a shared root; ``commit`` names the kind that is written last."""

    def __init__(self, spark: SparkSession, root: str, commit: str):
        self.spark, self.root, self.commit = spark, root.rstrip("/"), commit

    def path(self, kind: str, load: int) -> str:
        return f"{self.root}/{kind}/load-{load:06d}"

    def committed(self, load: int) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(self.commit, load)}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def write(self, kind: str, load: int, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(kind, load))
        return self.read(kind, [load], df.schema)

    def read(self, kind: str, loads, schema) -> DataFrame:
        paths = [self.path(kind, n) for n in loads]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def due(self, load: int) -> bool:
        """Whether the load is the next one; an earlier one is done, a later one cannot be taken yet."""
        if self.committed(load):
            return False
        if load and not self.committed(load - 1):
            raise ValueError(f"load {load} before load {load - 1}")
        return True


# ----------------------------------------------------------------- M6 stock windows
SNAPSHOT = ["product_sku", "stock_quantity", "category", "size", "color", "snapshot_date"]
TAIL_SCHEMA = ("product_sku string, stock_quantity int, category string, size string, color string, "
               "snapshot_date timestamp_ntz, stock_change int")
STOCK_SCHEMA = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FCT_INVENTORY.fields) \
    + ", avg_weekly_stock_change double"


class StockWindows:
    """fct_inventory with its moving average, load by load.

    A load holds rows of bronze stock (``loaded_timestamp`` later than every load before:
    an earlier or missing time would change rows that are out already, and is refused). Hot SKUs are
    split as in the full windows; the state holds at most MOVING_AVG_ROWS - 1 rows a SKU.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.folders = LoadFolders(spark, root, commit="tails")

    def tails(self, load: int) -> DataFrame:
        """The last rows of every SKU after the load (none before the first)."""
        return self.folders.read("tails", [load] if load >= 0 else [], TAIL_SCHEMA)

    def met(self, load: int, rows: DataFrame) -> DataFrame:
        """All that a load reads: its own rows and the tails before it (``_old``, their change is ``_known``)."""
        fresh = rows.selectExpr("sku_code AS product_sku", "stock_quantity", "category", "size", "color",
                                "loaded_timestamp AS snapshot_date", "CAST(NULL AS INT) AS _known", "false AS _old")
        return fresh.unionByName(self.tails(load - 1).withColumnRenamed("stock_change", "_known")
                                                     .withColumn("_old", F.lit(True)))

    def computed(self, load: int, rows: DataFrame) -> DataFrame:
        """The rows of ``met`` with both windows worked out."""
        lagged = lag_delta(self.met(load, rows), "product_sku", SNAPSHOT_ORDER, "stock_quantity", "previous_stock_quantity", "_delta")
        lagged = stage(lagged.selectExpr(*SNAPSHOT, "_old", "previous_stock_quantity",
                                         "IF(_old, _known, _delta) AS stock_change"), "stock_lagged")
        return moving_average(lagged, "product_sku", SNAPSHOT_ORDER, "stock_change", "avg_weekly_stock_change",
                              MOVING_AVG_ROWS)

    def load(self, load: int, rows: DataFrame) -> None:
        if not self.folders.due(load):
            return
        newest = self.tails(load - 1).agg(F.max("snapshot_date")).first()[0]
        first, missing = rows.agg(F.min("loaded_timestamp"), F.count_if(F.col("loaded_timestamp").isNull())).first()
        if missing or (newest is not None and first is not None and first <= newest):
            raise ValueError(f"load {load} holds stock of {'no time' if missing else first}, the state is of {newest}: "
                             "rebuild from the history")
        done = stage(self.computed(load, rows), "stock_windows")
        facts = done.where("NOT _old").selectExpr(
            "*", f"{stock_status('stock_quantity')} AS stock_status",
            f"{reorder_suggestion('stock_quantity')} AS reorder_suggestion")
        self.folders.write("facts", load, facts.selectExpr(
            *[f"CAST({q(f.name)} AS {f.dataType.simpleString()}) AS {q(f.name)}" for f in FCT_INVENTORY.fields],
            "avg_weekly_stock_change"))
        self.folders.write("tails", load, last_rows(
            done.select(*SNAPSHOT, "stock_change"), "product_sku", SNAPSHOT_ORDER, MOVING_AVG_ROWS - 1))

    def facts(self, loads: int) -> DataFrame:
        """The rows of the first ``loads`` loads."""
        return self.folders.read("facts", range(loads), STOCK_SCHEMA)


# ------------------------------------------------------------------ M9/M10 gold
@dataclass(frozen=True)
class Summary:
    """A grouped summary as state: ``parts`` are (aggregate over rows, function that merges two states).

    ``rows`` filters the fact and adds helper columns, ``reads`` names the fact's columns that it and the parts use; ``counted`` is the one true distinct, whose
    number goes to ``counted_as``; ``finish`` turns the groups into the summary's rows.
    """

    keys: list[str]
    counted: str
    counted_as: str
    rows: Callable[[DataFrame], DataFrame]
    reads: list[str]
    parts: dict[str, tuple[str, str]]
    finish: Callable[[DataFrame], DataFrame]


_SUMS = {
    "_units": ("sum(quantity)", "sum"), "_revenue": ("sum(gross_revenue_inr)", "sum"),
    "_price": ("sum(unit_price)", "sum"), "_prices": ("count(unit_price)", "sum"),
}


def _product_rows(groups: DataFrame) -> DataFrame:
    return groups.selectExpr(
        *gold.PRODUCT_KEYS, "total_transactions", "CAST(_units AS BIGINT) AS total_units_sold",
        "CAST(_revenue AS DOUBLE) AS total_revenue_inr", "try_divide(_price, _prices) AS avg_selling_price",
        f"{months_set()} AS active_months", "first_sale_date", "last_sale_date",
        f"{safe_ratio('_revenue', 'total_transactions')} AS avg_order_value", "_revenue")


def _region_rows(groups: DataFrame) -> DataFrame:
    return groups.selectExpr(
        *gold.REGION_KEYS, "total_orders", "CAST(_units AS BIGINT) AS total_units",
        "CAST(_revenue AS DOUBLE) AS total_revenue_inr", "try_divide(_price, _prices) AS avg_price",
        "CAST(_b2b AS DOUBLE) AS b2b_revenue", "CAST(_b2c AS DOUBLE) AS b2c_revenue",
        f"{gold.B2B_SHARE} AS b2b_percentage", "_revenue")


PRODUCT = Summary(
    gold.PRODUCT_KEYS, "sales_id", "total_transactions",
    lambda fact: with_month_bit(fact.where(NOT_CANCELLED), "order_date"),
    [*gold.PRODUCT_KEYS, "sales_id", "order_status", "order_date", "quantity", "gross_revenue_inr", "unit_price"],
    {**_SUMS, "first_sale_date": ("min(order_date)", "min"), "last_sale_date": ("max(order_date)", "max"),
     **{f"_m{i}": (bits.rpartition(" AS ")[0], "bit_or") for i, bits in zip(range(MONTH_WORDS), month_bits(), strict=True)}},
    _product_rows)

REGION = Summary(
    gold.REGION_KEYS, "sales_id", "total_orders",
    lambda fact: fact.where(f"{NOT_CANCELLED} AND ship_state IS NOT NULL"),
    [*gold.REGION_KEYS, "sales_id", "order_status", "quantity", "gross_revenue_inr", "unit_price", "is_b2b"],
    {**_SUMS, "_b2b": ("sum(CASE WHEN is_b2b THEN gross_revenue_inr ELSE 0 END)", "sum"),
     "_b2c": ("sum(CASE WHEN NOT is_b2b THEN gross_revenue_inr ELSE 0 END)", "sum")},
    _region_rows)


class IncrementalSummary:
    """A summary's groups, refreshed by loads of new fact rows.

    The sale keys that a group has counted are kept append-only, one folder a load. A load's distinct keys
    are met with them by a semi join, in which the load is the side that Spark may broadcast, so
    a small load scans the kept keys without shuffling them. Groups are rewritten by each load, as ranks need them all.
    """

    def __init__(self, spark: SparkSession, summary: Summary, root: str):
        self.summary, self.folders = summary, LoadFolders(spark, root, commit="groups")

    def groups(self, load: int) -> DataFrame:
        path = self.folders.path("groups", load)
        return self.folders.spark.read.parquet(path)

    def unseen(self, load: int, pairs: DataFrame) -> DataFrame:
        """Those (group, sale) pairs of the load that no load before has counted."""
        if not load:
            return pairs
        seen = self.folders.read("pairs", range(load), pairs.schema).alias("a")
        same = F.expr(" AND ".join(f"a.{q(c)} <=> b.{q(c)}" for c in pairs.columns))
        known = seen.join(pairs.alias("b"), same, "left_semi")
        return pairs.alias("a").join(known.alias("b"), same, "left_anti")

    def refresh(self, load: int, delta: DataFrame) -> None:
        if not self.folders.due(load):
            return
        s = self.summary
        rows = s.rows(delta)
        pairs = stage(rows.where(f"{q(s.counted)} IS NOT NULL").select(*s.keys, s.counted).distinct(), "load_pairs")
        fresh = self.folders.write("pairs", load, self.unseen(load, pairs))
        counts = fresh.groupBy(*s.keys).agg(F.count(F.lit(1)).alias(s.counted_as))
        states = gold.aggregate(rows, s.keys, [f"{a} AS {name}" for name, (a, _) in s.parts.items()])
        states = states.withColumn(s.counted_as, F.lit(0).cast("bigint")).unionByName(counts, allowMissingColumns=True)
        if load:
            states = states.unionByName(self.groups(load - 1))
        # a group's states are few (one a source), and sums of sums stay exact decimals
        merges = {**{name: merge for name, (_, merge) in s.parts.items()}, s.counted_as: "sum"}
        merged = gold.aggregate(states, s.keys, [f"{merge}({name}) AS {name}" for name, merge in merges.items()])
        types = {f.name: f.dataType.simpleString() for f in states.schema.fields}
        self.folders.write("groups", load, merged.selectExpr(
            *s.keys, *[f"CAST({name} AS {types[name]}) AS {name}" for name in merges]))

    def rows(self, load: int) -> DataFrame:
        """The summary's rows (before ranks) after the load."""
        return self.summary.finish(self.groups(load))


# -------------------------------------------------------------------- queries
def _root(spark: SparkSession, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/retail_lake/loads/{label}-{uuid.uuid4().hex}"


def by_loads(df: DataFrame, load: str, label: str) -> tuple[list[str], Callable[[str], DataFrame]]:
    """Write ``df`` in one folder a load; returns the loads in order and a reader that prunes to one of them."""
    spark, path = df.sparkSession, _root(df.sparkSession, label)
    laid = df.withColumn("load_id", F.expr(load))
    with folders_unsorted(spark):
        laid.write.partitionBy("load_id").parquet(path)
    table = spark.read.schema(laid.schema).parquet(path)
    ids = [r.load_id for r in table.select("load_id").distinct().orderBy("load_id").collect()]     # one a load
    return ids, lambda one: table.where(F.col("load_id").eqNullSafe(one)).drop("load_id")


def inventory_by_loads(history: DataFrame) -> DataFrame:
    """The stock history fed load by load, each by its own load time."""
    spark = history.sparkSession
    ids, rows = by_loads(history, "date_format(loaded_timestamp, 'yyyyMMddHHmmss')", "stock_history")
    windows = StockWindows(spark, _root(spark, "stock"))
    for n, one in enumerate(ids):
        windows.load(n, rows(one))
    return windows.facts(len(ids))


#: Arrival of a sale's lines in the fixture: lines of one sale come in different loads.
ARRIVAL = "CAST(pmod(coalesce(quantity, 0), 3) AS STRING)"


def refreshed(fct_sales: DataFrame, summary: Summary) -> DataFrame | None:
    """The summary's rows after the fact was fed in loads (None of an empty fact)."""
    spark = fct_sales.sparkSession
    ids, rows = by_loads(fct_sales.select(*summary.reads), ARRIVAL, "sales")     # the columns the summary reads
    state = IncrementalSummary(spark, summary, _root(spark, "summary"))
    for n, one in enumerate(ids):
        state.refresh(n, rows(one))
    return state.rows(len(ids) - 1) if ids else None


def product_summary_by_loads(fct_sales: DataFrame) -> DataFrame:
    rows = refreshed(fct_sales, PRODUCT)
    return gold.sales_summary_by_product(fct_sales) if rows is None else gold.ranked_products(rows)


def region_summary_by_loads(fct_sales: DataFrame) -> DataFrame:
    rows = refreshed(fct_sales, REGION)
    return gold.sales_summary_by_region(fct_sales) if rows is None else gold.ranked_regions(rows)
