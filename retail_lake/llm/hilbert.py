"""Sharding in Hilbert-curve order for multidimensional file pruning.

Each document's metadata (language, source, size) is quantised to a grid, the
cell's index on the Hilbert curve through the grid orders the documents, and
the order is cut into runs of equal row counts (law ``rows``: counts differ by
one at most), so every shard covers a compact part of the metadata space.

Ranks need no global sort: counts of the curve cells are added up along the
curve (their number is bounded by the grid), and inside a cell documents are
dealt to ``sub`` buckets by a hash of their row number, ranked per bucket.
A cell that holds a third of all rows is thus spread over its buckets. The
staged row numbers make the order the same if a task is run again, and the
whole documents, staged with them, get shard and slot by a join on the number.

Language and source are quantised by rank: a value's level is the share of rows whose value comes before
it in descending order, so a level holds neighbouring values and a shard a short range of them, and every level
about as many rows as the others (but for a value that alone has more).

The size dimension is logarithmic between the smallest and the largest size of
the input, so the longest texts never share a cell for being long.

Edge cases: null language and source are a category of their own, null text
has size 1 and the checksum of the empty text; ties on the curve are broken
by bucket, id and row number; repeated rows get slots of their own; fewer rows
than shards leave the last shards empty; empty tables give an empty result;
extra columns stay with their documents, whatever their names: an added column whose name is taken
gets underscores after it until it is free (``size_``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_lake.llm.common import ship_package, text_or_empty
from retail_lake.operators.ranking import global_ranks
from retail_lake.operators.stages import stage

BITS = 5                   # per dimension
ROWS_PER_BUCKET = 500_000


def hilbert_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of grid cells (rows x dimensions), by transposed Gray codes."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:                                             # undo the rotations from the top level down
        low = q - 1
        for i in range(dims):
            flip = (x[i] & q) != 0
            swap = (x[0] ^ x[i]) & low
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = np.where(flip, x[i], x[i] ^ swap)
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            index = index << 1 | (x[i] >> b & 1)
    return index


def with_curve_index(df: DataFrame, dimensions: list, name: str = "curve") -> DataFrame:
    """Add the Hilbert index of quantised dimensions (columns with values 0 to 2^BITS - 1)."""
    ship_package(df.sparkSession)

    @F.pandas_udf("bigint")
    def index(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in parts:
            yield pd.Series(hilbert_index(np.column_stack([c.to_numpy(dtype=np.int64) for c in batch])))

    return df.withColumn(name, index(*dimensions))


def _rank_level(rank: str, total: int) -> Column:
    """Level of a value from the rank of its first row among all rows."""
    return F.floor((F.col(rank) - 1) * F.lit(1 << BITS) / F.lit(max(total, 1))).cast("bigint")


def _level(size: Column, least: int, most: int) -> Column:
    """2^BITS levels, equal steps of the logarithm from the least size to the most."""
    if most <= least:
        return F.lit(0).cast("bigint")
    low, high = math.log2(least), math.log2(most)
    step = F.floor((F.log2(size) - F.lit(low)) * F.lit((1 << BITS) / (high - low)))
    return F.greatest(F.lit(0), F.least(F.lit((1 << BITS) - 1), step)).cast("bigint")


#: What place_documents adds to a document.
ADDED = ("size", "shard", "slot")


def added_names(columns: list[str]) -> dict[str, str]:
    """What the added columns are called beside the given ones."""
    taken, names = {c.lower() for c in columns}, {}
    for name in ADDED:
        free = name
        while free in taken:
            free += "_"
        taken.add(free)
        names[name] = free
    return names


def place_documents(documents: DataFrame, shards: int = 8) -> DataFrame:
    """Whole documents, all columns, with ``size`` (bytes of the text and one), ``shard`` and ``slot`` (see added_names)."""
    names = added_names(documents.columns)
    docs = stage(documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("doc"),
                                  (F.octet_length(text_or_empty("text")) + 1).cast("bigint").alias("size"),
                                  F.monotonically_increasing_id().alias("row")), "documents")
    least, most, total = docs.agg(F.min("size"), F.max("size"), F.count("*")).first()
    slim = docs.select("row", "size", F.col("doc.doc_id").alias("doc_id"), F.col("doc.lang").cast("string").alias("lang"),
                       F.col("doc.source").cast("string").alias("source"))
    slim = global_ranks(slim, {"lang_rank": "lang", "source_rank": "source"})
    rows = with_curve_index(slim, [_rank_level("lang_rank", total), _rank_level("source_rank", total),
                                   _level(F.col("size"), least or 1, most or 1)])
    rows = stage(rows.select("doc_id", "curve", "row"), "curve")
    # buckets of a cell: enough that each stays small even if one cell holds everything
    sub = max(64, math.ceil(total / ROWS_PER_BUCKET))
    rows = rows.withColumn("sub", F.pmod(F.xxhash64("row"), F.lit(sub)))
    buckets = stage(rows.groupBy("curve", "sub").agg(F.count("*").alias("n")), "buckets")
    cells = buckets.groupBy("curve").agg(F.sum("n").alias("n"))        # at most 2^(3 * BITS) rows
    cells = cells.select("curve", (F.sum("n").over(Window.orderBy("curve")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("curve").orderBy("sub")
    buckets = (buckets.withColumn("inside", F.sum("n").over(inside) - F.col("n")).join(cells, "curve")
                      .select("curve", "sub", (F.col("before") + F.col("inside")).alias("first")))
    place = F.row_number().over(Window.partitionBy("curve", "sub").orderBy("doc_id", "row")) - 1
    # buckets grow with the documents: never broadcast; the rows are dealt by the same key already
    ranked = (rows.withColumn("place", place).join(buckets.hint("merge"), ["curve", "sub"])
                  .withColumn("rank", F.col("first") + F.col("place")))
    small, large = total // shards, total % shards           # the first `large` shards take one row more
    edge = large * (small + 1)
    shard = (F.when(F.col("rank") < edge, F.expr(f"rank div {small + 1}"))
             .otherwise(F.expr(f"{large} + (rank - {edge}) div {max(small, 1)}")))
    start = F.when(F.col("rank") < edge, F.col("shard") * (small + 1)).otherwise(edge + (F.col("shard") - large) * small)
    placed = (ranked.withColumn("shard", shard.cast("int")).withColumn("slot", (F.col("rank") - start).cast("bigint"))
                    .select("row", "shard", "slot"))
    return docs.join(placed.hint("merge"), "row").select("doc.*", *[F.col(n).alias(names[n]) for n in ADDED])


def shard_documents(documents: DataFrame, shards: int = 8) -> DataFrame:
    """Digests of the placed documents: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    placed = place_documents(documents.select("doc_id", "text", "lang", "source"), shards)
    return placed.select("doc_id", "size", F.crc32(text_or_empty("text").cast("binary")).alias("text_crc32"),
                         F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(placed: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """One folder per shard, whole documents in slot order: the files' min/max of lang, source and size prune."""
    (placed.repartitionByRange(F.col(shard), F.col(slot)).sortWithinPartitions(shard, slot)
           .write.partitionBy(shard).parquet(path))
