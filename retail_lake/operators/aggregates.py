"""Aggregate helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_lake.functions.sql import q


def grand_total(df: DataFrame, value: str) -> Column:
    """SUM(value) over the whole frame as a scalar-subquery Column.

    Replaces ``CROSS JOIN (SELECT SUM(..))``: Spark evaluates the subquery once
    (reusing the upstream exchange) and uses the result as a literal; there is
    no join, and the only single-partition step is the final merge of one
    partial sum per task.
    """
    return df.selectExpr(f"sum({value})").scalar()


#: Months of the dates that two-digit years can name (1970 to 2069), by 64 to a long.
FIRST_YEAR, MONTHS = 1970, 1200
MONTH_WORDS = -(-MONTHS // 64)


def with_month_bit(df: DataFrame, date: str) -> DataFrame:
    """Add the place of the date's month in the domain: ``_word`` and ``_bit`` (NULL for a NULL date)."""
    month = f"((year({date}) - {FIRST_YEAR}) * 12 + month({date}) - 1)"
    return df.selectExpr("*", f"CAST({month} AS INT) AS _month").selectExpr(
        "*", "_month DIV 64 AS _word", "shiftleft(1L, _month % 64) AS _bit").drop("_month")


def month_bits() -> list[str]:
    """Aggregates ``_m0 ...`` over ``with_month_bit``: which months of the domain occur, a bit each.

    Bitwise OR merges partial results exactly, has no set to keep and stays in hash
    aggregation; a distinct count of months so costs no pass of its own. NULL dates set no bit.
    """
    return [f"bit_or(IF(_word = {i}, _bit, 0L)) AS _m{i}" for i in range(MONTH_WORDS)]


def months_set() -> str:
    """Number of months that ``month_bits`` found."""
    return "CAST(" + " + ".join(f"bit_count(_m{i})" for i in range(MONTH_WORDS)) + " AS BIGINT)"


def orders_and_months(df: DataFrame, keys: list[str], counted: str, date: str, parts: dict[str, tuple[str, str]],
                      counted_as: str, months_as: str) -> DataFrame:
    """Per key the distinct values of ``counted`` and the months of ``date``, with mergeable aggregates ``parts``
    ({name: (aggregate over rows, function that merges two states)}), in one pass over ``df``.

    Rows are sorted by counted value and key, and the first of each pair counts it: a task holds sorted rows,
    which spill, and no table of pairs. Months are counted by words of the domain, a group (key, word) each, so
    that no row or group carries the words of the whole domain.
    """
    pair = ", ".join(q(c) for c in [counted, *keys])
    flagged = with_month_bit(df, date).selectExpr(
        "*", f"row_number() OVER (PARTITION BY {pair} ORDER BY {q(counted)}) = 1 AND {q(counted)} IS NOT NULL AS _first")
    words = flagged.groupBy(*keys, "_word").agg(
        F.expr("count_if(_first) AS _counted"), F.expr("bit_or(_bit) AS _months"),
        *[F.expr(f"{a} AS {name}") for name, (a, _) in parts.items()])
    return words.groupBy(*keys).agg(
        F.expr(f"sum(_counted) AS {counted_as}"), F.expr(f"CAST(coalesce(sum(bit_count(_months)), 0) AS BIGINT) AS {months_as}"),
        *[F.expr(f"{merge}({name}) AS {name}") for name, (_, merge) in parts.items()])
