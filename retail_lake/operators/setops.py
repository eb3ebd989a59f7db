"""Set-style combinations of model inputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name (the reference's channel union)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def disjoint_outer_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Same rows as ``left FULL OUTER JOIN right ON 1=0``.

    A join whose condition is always false keeps every row of both sides once,
    padded with NULLs for the other side's columns. Written as a join, Spark
    plans a broadcast nested-loop join that ships one whole side to every
    task; as a union it is a narrow, shuffle-free concatenation.
    """
    return left.unionByName(right, allowMissingColumns=True)
