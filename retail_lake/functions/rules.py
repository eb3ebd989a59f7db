"""Rule-based classifications used by silver and gold models.

Each rule is a CASE chain over SQL expressions; the first matching branch
wins, as in SQL.
"""

from __future__ import annotations

from retail_lake.functions.sql import case, s

# ---- fixed values (labels and thresholds that results must reproduce) ----
# Product category: (source, prefix, label), checked in this order.
CATEGORY_BY_PREFIX = [
    ("stock", "AN", "Leggings"),
    ("amazon", "SET", "Set"),
    ("amazon", "JNE", "Kurta"),
    ("amazon", "MEN", "Men Kurta"),
    ("style", "BL", "Blouse"),
    ("style", "J", "Jacket"),
]
CATEGORY_OTHER = "Other"
# Stock status by stock quantity: = 0, <= 5, <= 20, <= 50, otherwise.
STOCK_OUT, STOCK_CRITICAL, STOCK_LOW, STOCK_NORMAL, STOCK_EXCESS = (
    "Out of Stock", "Critical Stock", "Low Stock", "Normal Stock", "Excess Stock")
STOCK_LIMITS = (5, 20, 50)
# Reorder suggestion by stock quantity: <= 5, <= 20, otherwise.
REORDER_NOW, REORDER_SOON, REORDER_NONE = ("Reorder Immediately", "Reorder Soon", "Stock Sufficient")
# Inventory action by days of inventory: < 7, < 14, < 30, > 90, otherwise.
ACTION_CRITICAL = "CRITICAL - Immediate Reorder Required"
ACTION_URGENT = "URGENT - Reorder This Week"
ACTION_NORMAL = "NORMAL - Reorder Soon"
ACTION_WARNING = "WARNING - Excess Inventory"
ACTION_HEALTHY = "HEALTHY - Stock Level Optimal"
ACTION_LIMITS = (7, 14, 30, 90)
NO_SALES_DAYS = 999        # days of inventory when nothing sold in the window
# Revenue tier by total revenue (INR): > 100000, > 50000, > 10000, otherwise.
TIER_PREMIUM, TIER_HIGH, TIER_MEDIUM, TIER_LOW = ("Premium", "High", "Medium", "Low")
TIER_LIMITS = (100000, 50000, 10000)
# --------------------------------------------------------------------------


def product_category(stock_sku: str, amazon_sku: str, intl_style: str) -> str:
    """First matching prefix rule wins; NULL inputs never match (startswith(NULL) is NULL)."""
    source = {"stock": stock_sku, "amazon": amazon_sku, "style": intl_style}
    return case([(f"startswith({source[src]}, {s(prefix)})", s(label))
                 for src, prefix, label in CATEGORY_BY_PREFIX], s(CATEGORY_OTHER))


def stock_status(qty: str) -> str:
    lo, mid, hi = STOCK_LIMITS
    return case([(f"{qty} = 0", s(STOCK_OUT)), (f"{qty} <= {lo}", s(STOCK_CRITICAL)),
                 (f"{qty} <= {mid}", s(STOCK_LOW)), (f"{qty} <= {hi}", s(STOCK_NORMAL))], s(STOCK_EXCESS))


def reorder_suggestion(qty: str) -> str:
    lo, mid, _ = STOCK_LIMITS
    return case([(f"{qty} <= {lo}", s(REORDER_NOW)), (f"{qty} <= {mid}", s(REORDER_SOON))], s(REORDER_NONE))


def daily_sales_rate(units: str, window_days: int) -> str:
    return f"(CAST({units} AS DOUBLE) / {float(window_days)}D)"


def days_of_inventory(stock: str, units: str, window_days: int) -> str:
    """stock / (units / window); NO_SALES_DAYS when nothing was sold."""
    return case([(f"{units} > 0", f"CAST({stock} AS DOUBLE) / (CAST({units} AS DOUBLE) / {float(window_days)}D)")],
                f"{float(NO_SALES_DAYS)}D")


def inventory_action(days: str) -> str:
    crit, urg, norm, excess = ACTION_LIMITS
    return case([(f"{days} < {crit}", s(ACTION_CRITICAL)), (f"{days} < {urg}", s(ACTION_URGENT)),
                 (f"{days} < {norm}", s(ACTION_NORMAL)), (f"{days} > {excess}", s(ACTION_WARNING))],
                s(ACTION_HEALTHY))


def suggested_reorder(days: str, rate: str, stock: str, window_days: int) -> str:
    """CEIL(rate * window) - stock when fewer than 14 days are left, else 0."""
    urgent = ACTION_LIMITS[1]
    return (f"CAST({case([(f'{days} < {urgent}', f'ceil({rate} * {float(window_days)}D) - {stock}')], '0')}"
            f" AS BIGINT)")


def revenue_tier(revenue: str) -> str:
    prem, high, med = TIER_LIMITS
    return case([(f"{revenue} > {prem}", s(TIER_PREMIUM)), (f"{revenue} > {high}", s(TIER_HIGH)),
                 (f"{revenue} > {med}", s(TIER_MEDIUM))], s(TIER_LOW))


def to_inr(amount: str, currency: str, usd_inr: float) -> str:
    """USD amounts times the fixed rate, other currencies unchanged (exact decimal)."""
    rate = f"CAST('{usd_inr}' AS DECIMAL(10,4))"                 # money has two decimals: six hold the product
    return case([(f"{currency} = 'USD'", f"{amount} * {rate}")], amount)


def safe_ratio(num: str, den: str) -> str:
    """num / NULLIF(den, 0) in double precision; NULL instead of an error."""
    return f"try_divide(CAST({num} AS DOUBLE), CAST(nullif({den}, 0) AS DOUBLE))"


def share_of_total(part: str, total: str, scale: int = 2) -> str:
    """ROUND(100 * part / total, scale); NULL when the total is 0 or NULL."""
    return f"round(try_divide(100.0D * CAST({part} AS DOUBLE), CAST({total} AS DOUBLE)), {scale})"
