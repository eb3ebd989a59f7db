"""Global RANK() without a single-partition window.

``RANK() OVER (ORDER BY v DESC)`` with no PARTITION BY makes Spark move every
row into one task. ``global_rank`` gives the same numbers with work spread by
value range:

1. ``counts``: one row per distinct value with its multiplicity (partial
   aggregation first, so a value shared by a third of the rows costs one row
   per map task).
2. The distinct values are range-partitioned in rank order (Spark samples the
   bounds and routes each value by binary search) and written with the number
   of their partition. Equal values always share one, so ties never straddle.
3. Per-partition totals (one row per partition; the only single-partition
   step, bounded by the partition count, not by the data) give each partition
   the number of rows ranked ahead of it.
4. Inside a partition a running sum of multiplicities over the distinct values
   gives the rows ahead within it; rank = 1 + both.
5. Rows get their rank by an equi-join on the value (null-safe). AQE picks a
   broadcast when the distinct-value table is small and splits skewed values.

NULLs sort last (as DESC NULLS LAST / ASC NULLS LAST) and tie with each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.functions.sql import q
from retail_lake.operators.stages import stage

_V, _N, _B = "__rank_value", "__rank_n", "__rank_bucket"


def value_rank_table(df: DataFrame, value: str, descending: bool = True, buckets: int | None = None) -> DataFrame:
    """(value, rank) for every distinct value of ``df[value]``, NULL included.

    ``buckets``: number of value ranges, by default the shuffle partitions.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    direction = "DESC" if descending else "ASC"
    order = F.col(_V).desc_nulls_last() if descending else F.col(_V).asc_nulls_last()
    counts = df.groupBy(F.col(value).alias(_V)).agg(F.count(F.lit(1)).alias(_N))
    tagged = stage(counts.repartitionByRange(buckets, order).withColumn(_B, F.spark_partition_id()), "rank_values")
    ahead = tagged.selectExpr(
        "*", f"coalesce(sum({_N}) OVER (PARTITION BY {_B} ORDER BY {_V} {direction} NULLS LAST "
             f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS __ahead")
    # at most one row per range: this single-partition window is bounded by their number
    offsets = tagged.groupBy(_B).agg(F.sum(_N).alias("__bucket_rows")).selectExpr(
        _B, "coalesce(sum(__bucket_rows) OVER (ORDER BY "
            f"{_B} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS __offset")
    ranked = ahead.join(F.broadcast(offsets), _B)
    return ranked.selectExpr(_V, "CAST(__offset + __ahead + 1 AS BIGINT) AS __rank")


def global_rank(df: DataFrame, value: str, out: str, descending: bool = True,
                buckets: int | None = None) -> DataFrame:
    """Append ``out`` = RANK() OVER (ORDER BY value [DESC] NULLS LAST)."""
    return global_ranks(df, {out: value}, descending, buckets)


def global_ranks(df: DataFrame, ranks: dict[str, str], descending: bool = True,
                 buckets: int | None = None) -> DataFrame:
    """Append several ranks ({out: value}); every rank table is built from the
    same input, so the plan grows linearly with the number of ranks."""
    out = df
    for name, value in ranks.items():
        table = value_rank_table(df, value, descending, buckets).withColumnsRenamed(
            {_V: f"__v_{name}", "__rank": name})
        out = out.join(table, F.expr(f"{q(value)} <=> {q('__v_' + name)}"), "left").drop(f"__v_{name}")
    return out
