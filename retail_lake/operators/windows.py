"""Per-key ordered window operators that split hot keys by ranges of their order.

A window partitioned by key alone puts all rows of a key into one task, whatever
their number (the empty SKU, for instance, has no bound). Here keys are counted first, and
a key of more than ROWS_A_TASK rows is hot. Hot keys' rows are
range-partitioned by key and order and written once; a range holds about ROWS_A_TASK rows, so a hot key
spans several. Every range is then padded with the few rows of its first key that stand
before it, and the window runs per (range, key). The pads come
from the ends of the ranges: a key can only go on past a range's end if it is the last of
that range, so at most one key and ``rows`` rows a range are carried, a table bounded by the number of ranges.
All other keys are met by the plain window. Values equal those of the plain window for every key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.functions.sql import q
from retail_lake.operators.stages import stage

ROWS_A_TASK = 1_000_000    # rows of a key that one task may sort; decides where windows are split, not their values
_RANGE, _PAD, _AT, _KEY = "__range", "__pad", "__at", "__key"


def _over(keys: str, order: str, frame: str = "") -> str:
    return f"OVER (PARTITION BY {keys} ORDER BY {order} {frame})"


def padded_ranges(df: DataFrame, key: str, order: str, rows: int, ranges: int) -> DataFrame:
    """``df`` with columns ``__range`` and ``__pad``: so many ranges of (key, order), each with the ``rows`` rows of
    its first key that precede it as pads."""
    by = [F.expr(f"{q(key)}").asc_nulls_first(), *(_sort_column(o) for o in order.split(","))]
    # a NULL key is a group like any other; nulls come first, so the last key of a range is its maximum
    cut = stage(df.repartitionByRange(ranges, *by).withColumn(_RANGE, F.spark_partition_id()), "ranges")
    ends = cut.groupBy(_RANGE).agg(F.expr(f"max(struct({q(key)} AS k)).k").alias(_KEY))
    going_on = ends.select(_KEY).distinct()                  # at most one key a range
    newest_first = ", ".join(_reversed(o) for o in order.split(","))
    tails = (cut.join(F.broadcast(going_on), F.expr(f"{q(key)} <=> {_KEY}"), "left_semi")
                .withColumn(_AT, F.expr(f"row_number() {_over(f'{_RANGE}, {q(key)}', newest_first)}"))
                .where(f"{_AT} <= {rows}"))
    # every range that holds a key has a row for the pads of the next: rows go ``rows`` such ranges on at most
    holds = cut.join(F.broadcast(going_on), F.expr(f"{q(key)} <=> {_KEY}"), "left_semi").groupBy(
        F.col(key).alias(_KEY), F.col(_RANGE).alias("__held")).agg(F.count(F.lit(1)).alias("__n")).selectExpr(
        _KEY, "__held", f"collect_list(__held) OVER (PARTITION BY {_KEY} ORDER BY __held "
                        f"ROWS BETWEEN 1 FOLLOWING AND {rows} FOLLOWING) AS __later")
    carried = tails.join(F.broadcast(holds), F.expr(f"{q(key)} <=> {_KEY} AND {_RANGE} = __held")).select(
        *[F.col(c) for c in cut.columns], F.explode("__later").alias("__to"))
    pads = (carried.withColumn(_AT, F.expr(f"row_number() {_over(f'__to, {q(key)}', newest_first)}"))
                   .where(f"{_AT} <= {rows}").withColumn(_RANGE, F.col("__to")).drop("__to", _AT))
    return cut.withColumn(_PAD, F.lit(False)).unionByName(pads.withColumn(_PAD, F.lit(True)))


def _sort_column(term: str):
    name, direction, nulls = _parts(term)
    c = F.col(name)
    return {("ASC", "FIRST"): c.asc_nulls_first, ("ASC", "LAST"): c.asc_nulls_last,
            ("DESC", "FIRST"): c.desc_nulls_first, ("DESC", "LAST"): c.desc_nulls_last}[direction, nulls]()


def _parts(term: str) -> tuple[str, str, str]:
    """Column, ASC or DESC, FIRST or LAST of one ``column [ASC|DESC] [NULLS FIRST|LAST]`` term."""
    words = term.split()
    direction = "DESC" if "DESC" in words else "ASC"
    nulls = words[-1] if "NULLS" in words else ("FIRST" if direction == "ASC" else "LAST")
    return words[0], direction, nulls


def _reversed(term: str) -> str:
    name, direction, nulls = _parts(term)
    return f"{name} {'ASC' if direction == 'DESC' else 'DESC'} NULLS {'LAST' if nulls == 'FIRST' else 'FIRST'}"


def _windowed(df: DataFrame, key: str, order: str, rows: int, exprs: list[str], rows_a_task: int) -> DataFrame:
    """Add the window expressions, in which ``{over}`` stands for the window's keys and order."""
    def plain(part: DataFrame) -> DataFrame:
        return part.selectExpr("*", *[e.format(over=f"PARTITION BY {q(key)} ORDER BY {order}") for e in exprs])

    # each hot key stands for over rows_a_task rows: their table is a small fraction of the data
    hot = stage(df.groupBy(F.col(key).alias(_KEY)).agg(F.count(F.lit(1)).alias("__n")).where(f"__n > {rows_a_task}"), "hot_keys")
    total = hot.agg(F.sum("__n")).first()[0]
    if total is None:
        return plain(df)
    met = F.expr(f"{q(key)} <=> {_KEY}")
    padded = padded_ranges(df.join(F.broadcast(hot.select(_KEY)), met, "left_semi"), key, order, rows,
                           -(-total // rows_a_task) + 1)
    split = padded.selectExpr("*", *[e.format(over=f"PARTITION BY {_RANGE}, {q(key)} ORDER BY {order}") for e in exprs])
    others = plain(df.join(F.broadcast(hot.select(_KEY)), met, "left_anti"))
    return others.unionByName(split.where(f"NOT {_PAD}").drop(_RANGE, _PAD))


def lag_delta(df: DataFrame, key: str, order: str, value: str, prev_out: str, delta_out: str,
              rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """Previous value per key and the change against it."""
    return _windowed(df, key, order, 1, [f"lag({value}) OVER ({{over}}) AS {prev_out}",
                                         f"{value} - lag({value}) OVER ({{over}}) AS {delta_out}"], rows_a_task)


def moving_average(df: DataFrame, key: str, order: str, value: str, out: str, rows: int,
                   rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """AVG(value) over the current row and ``rows - 1`` preceding rows per key."""
    return _windowed(df, key, order, rows - 1, [
        f"avg({value}) OVER ({{over}} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW) AS {out}"], rows_a_task)


def last_rows(df: DataFrame, key: str, order: str, rows: int) -> DataFrame:
    """The last ``rows`` rows of every key. The limit on row_number is also applied before the shuffle, so
    a hot key sends that many rows a map task."""
    newest_first = ", ".join(_reversed(o) for o in order.split(","))
    return (df.withColumn(_AT, F.expr(f"row_number() {_over(q(key), newest_first)}"))
              .where(f"{_AT} <= {rows}").drop(_AT))
