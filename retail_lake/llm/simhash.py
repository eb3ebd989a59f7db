"""SimHash near-duplicate detection with pivot distance tables.

1. Every document gets a 64-bit fingerprint: the bitwise majority of the
   XXH64 hashes of its four-word shingles. Equal fingerprints collapse to one
   row, so groups of exact copies never meet in a join.
2. Every fingerprint's Hamming distances to ``PIVOTS`` reference fingerprints
   are precomputed. By the triangle inequality two fingerprints within
   ``max_bits`` differ by at most ``max_bits`` in every coordinate, so a pair
   whose largest coordinate difference is greater is discarded; survivors are
   verified by their Hamming distance.
3. Pivot coordinates alone cannot deal 64-bit fingerprints to tasks (one pivot
   keeps more than half of all random pairs at 4 bits), so pairs meet by a
   lossless block key: of max_bits + 2 blocks of the 64 bits at least two are
   untouched, one bucket per pair of blocks.
4. Buckets never emit all their pairs. First each bucket links its members to
   its smallest fingerprint where the distance allows; those true links are
   contracted to components. Then only pairs of different components are
   compared, where a bucket holds more than one.
5. Components of all links give each document the smallest reachable doc_id.

Joins of tables that grow with the documents are sort-merge joins by hint:
Spark takes an exploded table for as small as the Parquet files under it, and
broadcasts it through the driver while these are under the threshold.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. Edge cases: null and
empty texts have fingerprint zero and are linked like any other; texts of one
to three words are hashed whole; documents with a null id take part, get the
smallest non-null id reachable, or null if there is none; repeated rows are
reported each; empty tables give an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_lake.llm.common import ship_package, text_or_empty
from retail_lake.llm.components import components
from retail_lake.operators.stages import stage

SHINGLE = 4
MAX_BITS = 4
SEED = 42
PIVOTS = 16
_CHUNK = 1 << 16           # hashes whose bits are counted at a time


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of the whole text as a signed 64-bit integer."""
    w = text.encode("utf-8", "replace").lower().split()
    n = len(w)
    if not n:
        return 0
    digest = xxhash.xxh64_intdigest
    if n < shingle:
        hashes = [digest(b" ".join(w), SEED)]
    else:
        hashes = [digest(b" ".join(w[i:i + shingle]), SEED) for i in range(n - shingle + 1)]
    h = np.array(hashes, dtype=np.uint64).astype("<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), _CHUNK):
        part = h[at:at + _CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(ones * 2 > len(h), bitorder="little")
    return int(majority.view("<i8")[0])


def pivot_fingerprints(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints: hashes of 0, 1, 2, ... as signed 64-bit integers."""
    return [int(np.uint64(xxhash.xxh64_intdigest(str(k), SEED)).astype(np.int64)) for k in range(n)]


def with_fingerprints(df: DataFrame, text_col: str = "text", shingle: int = SHINGLE, name: str = "fp") -> DataFrame:
    ship_package(df.sparkSession)

    @F.pandas_udf("bigint")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t, shingle) for t in batch], dtype="int64")

    return df.withColumn(name, fp(text_or_empty(text_col)))


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _buckets(fps: DataFrame, max_bits: int) -> DataFrame:
    """(bucket, key, fp, pivot distances, comp): one row per pair of blocks."""
    blocks, at = [], 0
    for k in range(max_bits + 2):
        width = 64 // (max_bits + 2) + (k < 64 % (max_bits + 2))
        blocks.append(((1 << width) - 1) << at)
        at += width
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    keys = [F.struct(F.lit(t).alias("bucket"), F.col("fp").bitwiseAND(F.lit(signed(a | b))).alias("key"))
            for t, (a, b) in enumerate(combinations(blocks, 2))]
    return fps.withColumn("__k", F.explode(F.array(*keys))).select("__k.*", *fps.columns)


def _near(left: str, right: str, max_bits: int) -> Column:
    """Largest pivot coordinate difference first, then the distance itself."""
    keep = F.lit(True)
    for k in range(PIVOTS):
        keep = keep & (F.abs(F.col(f"{left}.p{k}") - F.col(f"{right}.p{k}")) <= max_bits)
    return keep & (_distance(F.col(f"{left}.fp"), F.col(f"{right}.fp")) <= max_bits)


def fingerprint_components(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, comp) for every distinct fingerprint of ``fps`` (column fp): the smallest one reachable."""
    nodes = fps.select("fp").distinct()
    for k, pivot in enumerate(pivot_fingerprints()):
        nodes = nodes.withColumn(f"p{k}", _distance(F.col("fp"), F.lit(pivot)).cast("byte"))
    nodes = stage(nodes, "pivots")

    # links of each bucket's members to its smallest member, where near enough
    dealt = _buckets(nodes.select("fp"), max_bits)
    heads = (dealt.groupBy("bucket", "key").agg(F.min("fp").alias("head"), F.max("fp").alias("last"))
                  .where("head <> last").select("bucket", "key", "head"))
    stars = (dealt.join(heads.hint("merge"), ["bucket", "key"]).where(F.col("fp") != F.col("head"))
                  .where(_distance(F.col("fp"), F.col("head")) <= max_bits).select("fp", "head"))
    first = components(stars)

    # what is left: pairs of different components that share a bucket
    nodes = stage(nodes.join(first.withColumnRenamed("node", "fp").hint("merge"), "fp", "left")
                       .withColumn("comp", F.coalesce("root", "fp")).drop("root"), "contracted")
    dealt = _buckets(nodes, max_bits)
    mixed = (_buckets(nodes.select("fp", "comp"), max_bits).groupBy("bucket", "key")
             .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket", "key"))
    open_ = stage(dealt.join(mixed.hint("merge"), ["bucket", "key"]), "open")
    pairs = (open_.alias("a").join(open_.alias("b").hint("merge"), (F.col("a.bucket") == F.col("b.bucket"))
                                   & (F.col("a.key") == F.col("b.key"))
                                   & (F.col("a.comp") < F.col("b.comp")) & _near("a", "b", max_bits))
             .select(F.col("a.comp").alias("x"), F.col("b.comp").alias("y")))
    second = components(pairs).select(F.col("node").alias("comp"), "root")
    return (nodes.select("fp", "comp").join(second.hint("merge"), "comp", "left")
            .select("fp", F.coalesce("root", "comp").alias("comp")))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """Per row: id, fp (signed 64-bit) and component_id, the smallest id reachable over links."""
    docs = stage(with_fingerprints(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                                   "text", shingle).drop("text"), "fingerprints")
    classes = docs.groupBy("fp").agg(F.min("id").alias("id"))
    classes = classes.join(fingerprint_components(classes, max_bits).hint("merge"), "fp")
    smallest = classes.groupBy("comp").agg(F.min("id").alias("component_id"))
    of_fp = classes.select("fp", "comp").join(smallest.hint("merge"), "comp").select("fp", "component_id")
    return docs.join(of_fp.hint("merge"), "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def document_components(documents: DataFrame) -> DataFrame:
    """Per document the fingerprint and the component of the near-duplicate graph."""
    return (near_duplicates(documents)
            .select("doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id"))


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Pipeline stage: one document of each near-duplicate group, columns unchanged.

    The document with the smallest id stays (null ids last); of rows that tie
    in the id the one with the smallest content hash, then any one of them.
    """
    columns = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__doc"),
                       F.col("doc_id").alias("__id"), text_or_empty("text").alias("__t"))
    rows = (with_fingerprints(rows, "__t", shingle, "__fp").drop("__t")
            .withColumn("__h", F.xxhash64("__doc")).withColumn("__r", F.monotonically_increasing_id()))
    rows = stage(rows, "fingerprinted")                      # fixes the row numbers
    best = lambda: F.min(F.struct(F.col("__id").isNull().alias("n"), F.col("__id").alias("i"),
                                  F.col("__h").alias("h"), F.col("__r").alias("r"))).alias("best")
    classes = rows.groupBy(F.col("__fp").alias("fp")).agg(best())
    classes = classes.join(fingerprint_components(classes.select("fp"), max_bits).hint("merge"), "fp")
    keepers = classes.groupBy("comp").agg(F.min("best").alias("best")).select(F.col("best.r").alias("__r"))
    return rows.join(keepers, "__r", "left_semi").select("__doc.*")      # the documents are never broadcast
