"""Data-quality checks as Spark aggregates (one result row per check).

The reference names these validations but returns a constant 'passed'; here
every check reads the data. Checks on the rows of one table are aggregates of
one scan of that table, whatever their number (``counted``); the others are a
plan of their own (``measure``). Both produce ``violations`` and
``checked_rows`` without a collect; the result rows follow
``schemas.QUALITY_RESULT`` and the layer runner stops when any row of a gating
check has status 'failed'.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.functions.cleaning import parse_dmy
from retail_lake.functions.rules import (
    STOCK_CRITICAL, STOCK_EXCESS, STOCK_LOW, STOCK_NORMAL, STOCK_OUT,
)
from retail_lake.functions.sql import q, s
from retail_lake.lake import Lake
from retail_lake.operators.stages import shuffles_removed, stage
from retail_lake.params import RECENT_SALES_DAYS
from retail_lake.plans import gold, silver
from retail_lake.plans.silver import NOT_CANCELLED

# Freshness: the refresh cadence of the schedule.
FRESHNESS_HOURS = 6
# Relative tolerance when recomputed totals are compared.
METRIC_TOLERANCE = 1e-9
PASSED, WARNING, FAILED = "passed", "warning", "failed"


@dataclass(frozen=True)
class Check:
    layer: str
    table: str
    name: str
    severity: str
    measure: Callable[[Lake], DataFrame] | None = None      # -> one row: violations, checked_rows
    counted: Callable[[Lake], str] | None = None            # violations, an aggregate over the table's rows
    checked: str = "count(*)"                               # checked rows of a counted check


def _statuses(measured: DataFrame) -> DataFrame:
    """Result rows from layer, table_name, check_name, severity, violations, checked_rows."""
    return measured.selectExpr(
        "layer", "table_name", "check_name",
        f"CASE WHEN coalesce(violations, 0) = 0 THEN '{PASSED}' ELSE severity END AS status",
        "CAST(coalesce(violations, 0) AS BIGINT) AS violations",
        "CAST(coalesce(checked_rows, 0) AS BIGINT) AS checked_rows")


def _names(c: Check) -> str:
    return ", ".join(s(x) for x in (c.layer, c.table, c.name, c.severity))


def one_pass(lake: Lake, table: str, checks: list[Check]) -> DataFrame:
    """All counted checks of a table as one aggregate, a row for each."""
    aggs = [F.expr(f"CAST({e} AS BIGINT) AS {n}{i}") for i, c in enumerate(checks)
            for n, e in (("v", c.counted(lake)), ("n", c.checked))]
    rows = ", ".join(f"{_names(c)}, v{i}, n{i}" for i, c in enumerate(checks))
    return _statuses(model_table(lake, table).agg(*aggs).selectExpr(
        f"stack({len(checks)}, {rows}) AS (layer, table_name, check_name, severity, violations, checked_rows)"))


def result(measured: DataFrame, c: Check) -> DataFrame:
    return _statuses(measured.selectExpr(
        f"inline(array(struct({_names(c)}, violations, checked_rows))) AS "
        "(layer, table_name, check_name, severity, violations, checked_rows)"))


def run_checks(lake: Lake, checks: list[Check]) -> DataFrame:
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        if c.counted:
            by_table.setdefault(c.table, []).append(c)
    parts = [one_pass(lake, t, cs) for t, cs in by_table.items()]
    parts += [result(c.measure(lake), c) for c in checks if c.measure]
    return reduce(DataFrame.unionByName, parts)


def count_violations(df: DataFrame, violations: str, checked: str = "count(*)") -> DataFrame:
    return df.agg(F.expr(f"{violations} AS violations"), F.expr(f"{checked} AS checked_rows"))


def _nulls(col: str) -> str:
    return f"sum(CASE WHEN {q(col)} IS NULL THEN 1 ELSE 0 END)"


# --------------------------------------------------------------- Q1 nulls
BRONZE_REQUIRED = {
    "stg_amazon_sales": ["order_id", "sku", "order_status"],
    "stg_international_sales": ["sku", "customer_name"],
    "stg_stock_levels": ["sku_code", "stock_quantity"],
}


def model_table(lake: Lake, name: str) -> DataFrame:
    return {
        "raw_amazon_sales": lambda: lake.raw_amazon_sales,
        "raw_international_sales": lambda: lake.raw_international_sales,
        "raw_stock_levels": lambda: lake.raw_stock_levels,
        "stg_amazon_sales": lambda: lake.stg_amazon_sales,
        "stg_international_sales": lambda: lake.stg_international_sales,
        "stg_stock_levels": lambda: lake.stg_stock_levels,
        "stg_stock_history": lambda: lake.stg_stock_history,
        "dim_customers": lambda: lake.dim_customers(),
        "dim_customers_resolved": lambda: lake.dim_customers(resolved=True),
        "dim_products": lambda: lake.dim_products(),
        "dim_products_one_per_sku": lambda: lake.dim_products(one_row_per_sku=True),
        "fct_sales": lambda: lake.fct_sales(),
        "fct_sales_one_per_sku": lambda: lake.fct_sales(one_row_per_sku=True),
        "fct_inventory": lambda: lake.fct_inventory,
    }[name]()


def null_checks() -> list[Check]:
    return [Check("bronze", t, f"not_null:{c}", FAILED, counted=lambda lake, c=c: _nulls(c))
            for t, cols in BRONZE_REQUIRED.items() for c in cols]


# ---------------------------------------------------------- Q2 duplicates
DUPLICATE_KEYS = {
    ("bronze", "stg_stock_levels"): ["sku_code"],
    ("silver", "dim_products"): ["product_sku"],
    ("silver", "dim_products_one_per_sku"): ["product_sku"],
    ("silver", "dim_customers"): ["customer_id"],
}


def _duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first per key (NULL is a key value, as in GROUP BY)."""
    per_key = df.groupBy(*keys).agg(F.expr("count(*) AS n"))
    return count_violations(per_key, "sum(n - 1)", "sum(n)")


def duplicate_checks() -> list[Check]:
    return [Check(layer, t, "duplicates:" + ",".join(keys), WARNING,
                  lambda lake, t=t, keys=keys: _duplicates(model_table(lake, t), keys))
            for (layer, t), keys in DUPLICATE_KEYS.items()]


# ------------------------------------------------------------ Q3 castable
def castable_checks() -> list[Check]:
    """Dates that do not parse; numbers and booleans are typed when landed (see seed_value_results)."""
    return [Check("bronze", raw, f"castable:{col}", WARNING, checked=f"count({q(col)})",
                  counted=lambda lake, col=col: f"count_if({q(col)} IS NOT NULL AND {parse_dmy(col)} IS NULL)")
            for raw, col in (("raw_amazon_sales", "Date"), ("raw_international_sales", "DATE"))]


def seed_value_results(malformed: DataFrame) -> DataFrame:
    """Result rows for the values of seed files that did not cast (``sources.seeds.malformed_values``)."""
    return _statuses(malformed.where("data_type <> 'string'").selectExpr(
        "'bronze' AS layer", "table_name", "concat('castable:', column_name) AS check_name",
        f"'{WARNING}' AS severity", "malformed AS violations", "present AS checked_rows"))


# ---------------------------------------------------------- Q4 row counts
ROW_COUNT_KEYS = [("stg_amazon_sales", "raw_amazon_sales", "Order ID"),
                  ("stg_international_sales", "raw_international_sales", "SKU"),
                  ("stg_stock_levels", "raw_stock_levels", "SKU Code")]


def row_count_checks() -> list[Check]:
    """Rejected rows are reported; raw rows that are neither staged nor rejected, or staged twice, fail."""
    def null_keys(key: str) -> str:
        return f"sum(CASE WHEN trim({q(key)}) IS NULL THEN 1 ELSE 0 END)"

    def unaccounted(lake: Lake, t: str, raw: str, key: str) -> DataFrame:
        staged = model_table(lake, t).selectExpr("count(*)").scalar()
        return count_violations(getattr(lake, raw), f"coalesce({null_keys(key)}, 0)").select(
            F.abs(F.col("checked_rows") - F.col("violations") - staged).alias("violations"), "checked_rows")
    out = []
    for t, raw, key in ROW_COUNT_KEYS:
        out.append(Check("bronze", t, "rejected_rows", WARNING,
                         lambda lake, raw=raw, key=key: count_violations(getattr(lake, raw), null_keys(key))))
        out.append(Check("bronze", t, "rows_accounted_for", FAILED,
                         lambda lake, t=t, raw=raw, key=key: unaccounted(lake, t, raw, key)))
    return out


# ------------------------------------------------------ Q5 business rules
STOCK_LABELS = [STOCK_OUT, STOCK_CRITICAL, STOCK_LOW, STOCK_NORMAL, STOCK_EXCESS]


def business_rule_checks() -> list[Check]:
    labels = ", ".join(f"'{x}'" for x in STOCK_LABELS)
    rules = [
        ("bronze", "stg_amazon_sales", "quantity_non_negative", "quantity < 0"),
        ("bronze", "stg_amazon_sales", "amount_non_negative", "amount < 0"),
        ("bronze", "stg_international_sales", "quantity_non_negative", "quantity < 0"),
        ("bronze", "stg_stock_levels", "stock_non_negative", "stock_quantity < 0"),
        ("silver", "fct_sales", "no_cancelled_orders", "order_status = 'Cancelled'"),
        ("silver", "fct_inventory", "known_stock_status",
         f"stock_status IS NULL OR stock_status NOT IN ({labels})"),
    ]
    return [Check(layer, t, name, FAILED, counted=lambda lake, bad=bad: f"count_if({bad})")
            for layer, t, name, bad in rules]


# ------------------------------------------------- Q6 referential integrity
def referential_checks() -> list[Check]:
    def orphans(lake: Lake) -> DataFrame:
        sales = silver.sales_channels(lake.stg_amazon_sales, lake.stg_international_sales).where(
            "sales_id IS NOT NULL")
        keys = lake.dim_products().selectExpr("product_sku").distinct()
        flagged = sales.join(keys.selectExpr("product_sku", "true AS known"),
                             F.expr("sku = product_sku"), "left")
        return count_violations(flagged, "sum(CASE WHEN known IS NULL THEN 1 ELSE 0 END)")
    return [Check("silver", "fct_sales", "sku_in_dim_products", WARNING, orphans)]


# ------------------------------------------------ Q7 aggregation accuracy
def aggregation_checks() -> list[Check]:
    def staged(lake: Lake) -> DataFrame:
        return silver.sales_channels(lake.stg_amazon_sales, lake.stg_international_sales).where(
            "sales_id IS NOT NULL").agg(F.expr("count(*) AS rows"), F.expr("sum(amount) AS amount"))

    def rows_kept(lake: Lake, t: str) -> DataFrame:
        staged_rows = staged(lake).select("rows").scalar()
        return model_table(lake, t).agg(F.count(F.lit(1)).alias("f_rows")).select(
            F.abs(F.col("f_rows") - staged_rows).alias("violations"), F.col("f_rows").alias("checked_rows"))

    def amount_kept(lake: Lake, t: str) -> DataFrame:
        fct = model_table(lake, t).agg(F.expr("sum(amount) AS f_amount"), F.expr("count(*) AS f_rows"))
        total = staged(lake).select("amount").scalar()
        return fct.select(F.when(F.col("f_amount") == total, F.lit(0)).otherwise(F.lit(1)).alias("violations"),
                          F.col("f_rows").alias("checked_rows"))
    out = []
    for t in ("fct_sales", "fct_sales_one_per_sku"):
        out.append(Check("silver", t, "row_count_preserved", FAILED, lambda lake, t=t: rows_kept(lake, t)))
        out.append(Check("silver", t, "amount_preserved", FAILED, lambda lake, t=t: amount_kept(lake, t)))
    return out


# ----------------------------------------------------------- Q8 freshness
def freshness_checks() -> list[Check]:
    """The newest load and the newest event against the day the run reports on."""
    def stale(lake: Lake, column: str, allowed: str) -> str:
        latest, day = f"max({column})", f"DATE '{lake.params.as_of.isoformat()}'"
        return f"CASE WHEN {latest} IS NULL OR {latest} < {day} - INTERVAL {allowed} THEN 1 ELSE 0 END"
    loads = [Check("bronze", t, f"loaded_within_{FRESHNESS_HOURS}h", FAILED,
                   counted=lambda lake: stale(lake, "loaded_timestamp", f"{FRESHNESS_HOURS} HOURS"))
             for t in ("stg_amazon_sales", "stg_international_sales", "stg_stock_levels")]
    events = [Check("bronze", t, f"sold_within_{RECENT_SALES_DAYS}d", WARNING,
                    counted=lambda lake: stale(lake, "order_date", f"{RECENT_SALES_DAYS} DAYS"))
              for t in ("stg_amazon_sales", "stg_international_sales")]
    return loads + events


# ---------------------------------------------------------- Q9 metrics
def _total_matches(gold_rows: DataFrame, silver_total) -> DataFrame:
    """1 violation when the gold revenue total differs from the silver total."""
    g = F.col("g")
    close = F.abs(g - silver_total) <= F.lit(METRIC_TOLERANCE) * F.greatest(F.abs(silver_total), F.lit(1.0))
    return gold_rows.agg(F.sum("total_revenue_inr").alias("g"), F.count(F.lit(1)).alias("n")).select(
        F.when(close, F.lit(0)).otherwise(F.lit(1)).alias("violations"), F.col("n").alias("checked_rows"))


def metric_checks() -> list[Check]:
    def silver_total(lake: Lake, where: str):
        return lake.fct_sales().where(where).selectExpr("CAST(sum(gross_revenue_inr) AS DOUBLE)").scalar()

    # the fact is read for both sides, so it is written before the summary is planned
    def product_total(lake: Lake) -> DataFrame:
        total = silver_total(lake, NOT_CANCELLED)
        return _total_matches(lake.sales_summary_by_product(sort=False), total)

    def region_total(lake: Lake) -> DataFrame:
        total = silver_total(lake, f"{NOT_CANCELLED} AND ship_state IS NOT NULL")
        return _total_matches(lake.sales_summary_by_region(sort=False), total)

    def shares(lake: Lake) -> DataFrame:
        """Each share is rounded to 2 places, so the sum may drift by 0.005 per group."""
        g = lake.sales_summary_by_region(sort=False)
        return g.agg(F.expr("sum(revenue_share_percentage) AS s"), F.expr("count(*) AS n")).selectExpr(
            "CASE WHEN abs(s - 100.0D) <= 0.005D * n + 1e-9D THEN 0 ELSE 1 END AS violations", "n AS checked_rows")
    return [Check("gold", "sales_summary_by_product", "revenue_matches_silver", FAILED, product_total),
            Check("gold", "sales_summary_by_region", "revenue_matches_silver", FAILED, region_total),
            Check("gold", "sales_summary_by_region", "shares_sum_to_100", FAILED, shares)]


# ------------------------------------------------------ Q10 completeness
def completeness_checks() -> list[Check]:
    def missing(lake: Lake, keys: list[str], where: str, rows: Callable[[], DataFrame]) -> DataFrame:
        """Silver group keys with no gold row (NULL keys compare equal).

        The groups are written once, for the join and for their number. The fact's plan gives them
        unless the run has written the fact: only the keys move, and no row of it is written.
        """
        with shuffles_removed(lake.spark):
            src = stage(lake.fct_sales_once().where(where).select(*keys).distinct(), "silver_groups")
            g = rows().select(*keys)
        cond = reduce(lambda a, b: a & b, [src[k].eqNullSafe(g[k]) for k in keys])
        return src.join(g, cond, "left_anti").agg(F.count(F.lit(1)).alias("violations")).select(
            "violations", src.agg(F.count(F.lit(1))).scalar().alias("checked_rows"))
    return [
        Check("gold", "sales_summary_by_product", "all_product_groups_present", FAILED,
              lambda lake: missing(lake, gold.PRODUCT_KEYS, NOT_CANCELLED,
                                   lambda: lake.sales_summary_by_product(sort=False))),
        Check("gold", "sales_summary_by_region", "all_region_groups_present", FAILED,
              lambda lake: missing(lake, gold.REGION_KEYS, f"{NOT_CANCELLED} AND ship_state IS NOT NULL",
                                   lambda: lake.sales_summary_by_region(sort=False))),
    ]


# -------------------------------------------------- Q11 / Q12 column tests
# (layer, table, column, severity); customer_id repeats by design (an order
# shipped to two addresses is two "customers"), so it only warns.
UNIQUE_COLUMNS = [("silver", "dim_customers", "customer_id", WARNING),
                  ("silver", "dim_products", "product_sku", FAILED),
                  ("silver", "dim_products_one_per_sku", "product_sku", FAILED),
                  ("bronze", "stg_stock_levels", "sku_code", FAILED)]
NOT_NULL_COLUMNS = [("silver", "dim_customers", "customer_id"), ("silver", "dim_products", "product_sku"),
                    ("silver", "fct_sales", "sales_id"), ("silver", "fct_inventory", "product_sku"),
                    ("silver", "fct_inventory", "snapshot_date")]


def unique_checks() -> list[Check]:
    """dbt-style ``unique``: number of non-NULL values that occur more than once."""
    def measure(lake: Lake, t: str, c: str) -> DataFrame:
        per_value = model_table(lake, t).where(f"{q(c)} IS NOT NULL").groupBy(c).agg(F.expr("count(*) AS n"))
        return count_violations(per_value, "sum(CASE WHEN n > 1 THEN 1 ELSE 0 END)", "sum(n)")
    return [Check(layer, t, f"unique:{c}", sev, lambda lake, t=t, c=c: measure(lake, t, c))
            for layer, t, c, sev in UNIQUE_COLUMNS]


def not_null_checks() -> list[Check]:
    """dbt-style ``not_null``: number of NULLs in the column."""
    return [Check(layer, t, f"not_null:{c}", FAILED, counted=lambda lake, c=c: _nulls(c))
            for layer, t, c in NOT_NULL_COLUMNS]


QUALITY_QUERIES = {
    "dq_nulls": (null_checks, "Q1"),
    "dq_duplicates": (duplicate_checks, "Q2"),
    "dq_castable": (castable_checks, "Q3"),
    "dq_row_counts": (row_count_checks, "Q4"),
    "dq_business_rules": (business_rule_checks, "Q5"),
    "dq_referential": (referential_checks, "Q6"),
    "dq_aggregation": (aggregation_checks, "Q7"),
    "dq_freshness": (freshness_checks, "Q8"),
    "dq_metrics": (metric_checks, "Q9"),
    "dq_completeness": (completeness_checks, "Q10"),
    "dq_unique": (unique_checks, "Q11"),
    "dq_not_null": (not_null_checks, "Q12"),
}



def layer_checks(layer: str) -> list[Check]:
    """Every check that belongs to one layer (run after that layer is built)."""
    return [c for family, _ in QUALITY_QUERIES.values() for c in family() if c.layer == layer]
