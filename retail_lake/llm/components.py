"""Connected components of a link table by alternating star contraction.

Each round hangs neighbours under the smallest node of a neighbourhood (large
star, then small star) with one grouped minimum and one join on the node; no
neighbourhood is ever gathered. The join is a sort-merge join by hint: nodes
grow with the links, and files look smaller than their rows. The number of
rounds grows with the logarithm of the longest chain. Every round is written to
the shared checkpoint folder, so lineage stays short and a lost executor
re-reads files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.operators.stages import stage


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u, v) with u > v."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (both.join(low.hint("merge"), "u").where("v > u and v <> m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = (large.join(low.hint("merge"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .union(low.select("u", F.col("m").alias("v"))))
    return small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node; the root is the smallest node reachable.

    ``links`` has two columns of one orderable type. Loops and repeated links
    are allowed; links with a null end are ignored.
    """
    a, b = links.columns
    edges = stage(links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                  .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    state = None
    while True:
        n, total = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if n == 0 or (n, total) == state:                    # a further round changes nothing: all stars
            break
        state = (n, total)
        edges = stage(_stars(edges), "stars")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
