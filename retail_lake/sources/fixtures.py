"""Raw tables played by the driver's star schema.

The reference ships no seed CSVs, so the three raw tables are derived from the
TPC-H-like parquet tables. Every lineitem row lands in exactly one sales
channel (line 1-5 -> marketplace, line 6+ -> international) and every part row
lands in the stock file; dirt (padding, NULLs, negatives, cancelled orders,
missing keys) is injected by fixed arithmetic rules so Spark and the SQL oracle
see identical input. Rows "missing" from a channel carry a NULL key and are
removed by the bronze model's own required-key filter. A query on one channel
reads that channel's lines; queries on both read every line.

The mapping is mirrored, written independently, in ``retail_lake.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lake.functions.sql import case, s
from retail_lake.schemas import STAR_SCHEMAS

STAR_TABLES = tuple(STAR_SCHEMAS)

# Fixed values of the fixture mapping (see FIXTURES.md).
SKU_PREFIXES = ["AN", "SET", "JNE", "MEN", "J", "BTM"]        # by p_partkey % 6
STYLE_PREFIXES = ["BL", "J", "K"]                             # by p_partkey % 3
LINE_SIZES = ["S", "M ", "L"]                                  # by l_linenumber % 3
STOCK_SIZES = ["S", "M", "L", None]                            # by p_size % 4
MARKETPLACE_MAX_LINE = 5
SNAPSHOT_DAYS = 8                                              # stock history 2001-07-20 .. 2001-07-27


def read_star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan with the declared schema: no schema-inference job, and
    Catalyst still prunes columns and pushes filters into the reader."""
    return spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _pick(values, idx: str) -> str:
    return case([(f"{idx} = {i}", s(v)) for i, v in enumerate(values)], "CAST(NULL AS STRING)")


SKU = f"concat({_pick(SKU_PREFIXES, 'p_partkey % 6')}, lpad(CAST(p_partkey AS STRING), 6, '0'))"
SIZE = _pick(LINE_SIZES, "l_linenumber % 3")
QTY = ("CASE WHEN l_orderkey % 17 = 0 THEN -1 WHEN l_orderkey % 19 = 0 THEN CAST(NULL AS INT) "
       "ELSE CAST(l_quantity AS INT) END")
DMY = "date_format(o_orderdate, 'dd-MM-yy')"
MONEY = "DECIMAL(18,2)"


def _base(spark: SparkSession, sf_dir: str, line_filter: str) -> DataFrame:
    """lineitem x orders x part x customer x nation, only the columns used.

    Orders meets its customer and nation first, so these joins move one row an
    order and not one a line. Orders is met by a sort-merge join; the other equi-joins are left to
    Catalyst/AQE, which broadcasts where the runtime size is under the threshold.
    The line filter reaches the lineitem scan as a pushed filter.
    """
    li = read_star(spark, sf_dir, "lineitem").where(line_filter).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    o = read_star(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = read_star(spark, sf_dir, "part").select("p_partkey", "p_type")
    c = read_star(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read_star(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    placed = (o.join(c, F.expr("o_custkey = c_custkey"))
               .join(n, F.expr("c_nationkey = n_nationkey")))
    # orders grows with lineitem: always met by a shuffle on the order key, never broadcast
    return (li.join(placed.hint("merge"), F.expr("l_orderkey = o_orderkey"))
              .join(p, F.expr("l_partkey = p_partkey")))


def raw_amazon_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _base(spark, sf_dir, f"l_linenumber <= {MARKETPLACE_MAX_LINE}")
    return b.selectExpr(
        "CASE WHEN l_orderkey % 997 = 0 THEN CAST(NULL AS STRING) "
        "ELSE concat(' ORD-', CAST(l_orderkey AS STRING), ' ') END AS `Order ID`",
        f"{DMY} AS `Date`",
        "CASE WHEN l_orderkey % 11 = 0 THEN 'Cancelled' WHEN l_orderkey % 13 = 0 THEN CAST(NULL AS STRING) "
        "ELSE ' Shipped ' END AS `Status`",
        "CASE WHEN l_suppkey % 2 = 0 THEN ' Amazon' ELSE 'Merchant ' END AS `Fulfilment`",
        "'Amazon.in ' AS `Sales Channel `",
        f"CASE WHEN (l_orderkey + l_partkey) % 101 = 0 THEN CAST(NULL AS STRING) ELSE concat(' ', {SKU}) END AS `SKU`",
        "p_type AS `Category`",
        f"{SIZE} AS `Size`",
        f"{QTY} AS `Qty`",
        f"CASE WHEN l_orderkey % 23 = 0 THEN CAST(NULL AS {MONEY}) "
        f"ELSE CAST(CAST(l_quantity AS INT) * (50 + p_partkey % 400) AS {MONEY}) END AS `Amount`",
        "CASE WHEN l_orderkey % 29 = 0 THEN CAST(NULL AS STRING) ELSE 'INR' END AS `currency`",
        "concat('City ', CAST((c_custkey + l_linenumber % 2) % 40 AS STRING)) AS `ship-city`",
        "CASE WHEN o_orderkey % 31 = 0 THEN CAST(NULL AS STRING) ELSE n_name END AS `ship-state`",
        "CAST(100000 + c_custkey AS STRING) AS `ship-postal-code`",
        "'IN ' AS `ship-country`",
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN true WHEN c_mktsegment = 'FURNITURE' THEN CAST(NULL AS BOOLEAN) "
        "ELSE false END AS `B2B`",
    )


def raw_international_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _base(spark, sf_dir, f"l_linenumber > {MARKETPLACE_MAX_LINE}")
    return b.selectExpr(
        "CASE WHEN c_custkey % 37 = 0 THEN CAST(NULL AS STRING) ELSE c_name END AS `CUSTOMER`",
        f"CASE WHEN p_partkey % 10 = 9 THEN CAST(NULL AS STRING) ELSE concat({SKU}, ' ') END AS `SKU`",
        f"{DMY} AS `DATE`",
        f"substr({DMY}, 4, 5) AS `Months`",
        f"concat({_pick(STYLE_PREFIXES, 'p_partkey % 3')}, CAST(p_partkey % 50 AS STRING)) AS `Style`",
        f"{SIZE} AS `Size`",
        f"{QTY} AS `PCS`",
        f"CAST(1 + p_partkey % 9 AS {MONEY}) AS `RATE`",
        f"CASE WHEN l_orderkey % 23 = 0 THEN CAST(NULL AS {MONEY}) "
        f"ELSE CAST(CAST(l_quantity AS INT) * (1 + p_partkey % 9) AS {MONEY}) END AS `GROSS AMT`",
    )


def raw_stock_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_star(spark, sf_dir, "part").selectExpr(
        f"CASE WHEN p_partkey % 10 >= 7 THEN CAST(NULL AS STRING) ELSE concat({SKU}, ' ') END AS `SKU Code`",
        "concat(' ', p_brand) AS `Design No.`",
        "CASE WHEN p_partkey % 41 = 0 THEN CAST(NULL AS INT) WHEN p_partkey % 43 = 0 THEN -3 "
        "ELSE CAST((p_partkey * 7) % 80 AS INT) END AS `Stock`",
        "CASE WHEN p_partkey % 47 = 0 THEN CAST(NULL AS STRING) ELSE p_type END AS `Category`",
        f"{_pick(STOCK_SIZES, 'p_size % 4')} AS `Size`",
        "split(p_name, ' ')[0] AS `Color`",
    )


def raw_stock_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily stock files for 2001-07-20 .. 2001-07-27, each with its load time.

    Generated with ``explode(sequence(..))`` (a per-row generator, no join);
    output grows linearly with ``part``. A part file is small for its rows, so they
    are dealt over the cores before they multiply.
    """
    raw = raw_stock_levels(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism)
    days = raw.selectExpr("*", f"explode(sequence(0, {SNAPSHOT_DAYS - 1})) AS _day")
    return days.selectExpr(
        "`SKU Code`", "`Design No.`",
        "CAST((`Stock` * (_day + 1) + _day * 5) % 61 AS INT) AS `Stock`",
        "`Category`", "`Size`", "`Color`",
        "make_timestamp_ntz(2001, 7, 20 + _day, 0, 0, 0) AS loaded_timestamp")
