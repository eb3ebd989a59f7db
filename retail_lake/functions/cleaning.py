"""Cleaning rules of the bronze layer, as Spark SQL expressions.

Each helper takes a raw header (or an SQL expression) and returns expression
text; all of them compile to Catalyst expressions inside whole-stage codegen,
none needs Python at run time.
"""

from __future__ import annotations

from retail_lake.functions.sql import q, s

UNKNOWN = "Unknown"
DEFAULT_CURRENCY = "INR"
# Two-digit years at or above this value are 19yy, below it 20yy (1970-2069).
TWO_DIGIT_YEAR_PIVOT = 70
DMY_PATTERN = r"^(\d{1,2})-(\d{1,2})-(\d{2})$"


def ref(name_or_expr: str) -> str:
    """A raw header becomes a quoted identifier; ``=expr`` passes an expression."""
    return name_or_expr[1:] if name_or_expr.startswith("=") else q(name_or_expr)


def clean_text(c: str) -> str:
    """TRIM(c): strips spaces only, keeps '' as ''."""
    return f"trim({ref(c)})"


def text_or_default(c: str, default: str = UNKNOWN) -> str:
    """COALESCE(TRIM(c), default). An empty string stays '' (it is not NULL)."""
    return f"coalesce(trim({ref(c)}), {s(default)})"


def clamp_count(c: str, null_value: int = 0) -> str:
    """Negative -> 0, NULL -> null_value, else the value (int)."""
    x = ref(c)
    return f"CAST(CASE WHEN {x} < 0 THEN 0 WHEN {x} IS NULL THEN {null_value} ELSE {x} END AS INT)"


def number_or_zero(c: str) -> str:
    return f"coalesce({ref(c)}, 0)"


def flag_or_false(c: str) -> str:
    return f"coalesce({ref(c)}, false)"


def parse_dmy(c: str, pivot: int = TWO_DIGIT_YEAR_PIVOT) -> str:
    """Parse 'DD-MM-YY' into a DATE; anything unparseable becomes NULL.

    One pattern test and one parse per value. Spark's ``yy`` always means
    20yy; years from the pivot on are moved back a century (from the pivot on
    both centuries have the same leap years, so the day stays). Impossible
    dates (31-02-01) are NULL through ``try_to_timestamp``, not an ANSI error.
    """
    t = f"trim({ref(c)})"
    century = f"CASE WHEN right({t}, 2) >= '{pivot:02d}' THEN -1200 ELSE 0 END"
    return (f"(CASE WHEN {t} RLIKE {s(DMY_PATTERN)} "
            f"THEN add_months(CAST(try_to_timestamp({t}, 'd-M-yy') AS DATE), {century}) END)")


def dmy_castable(c: str) -> str:
    """True when the raw date string is NULL or parses (schema checks)."""
    return f"({ref(c)} IS NULL OR {parse_dmy(c)} IS NOT NULL)"


def transaction_key(customer: str, sku: str, date: str) -> str:
    """CUSTOMER_SKU_DATE; NULL as soon as any part is NULL (SQL CONCAT)."""
    return f"concat(trim({ref(customer)}), '_', trim({ref(sku)}), '_', CAST({ref(date)} AS STRING))"
