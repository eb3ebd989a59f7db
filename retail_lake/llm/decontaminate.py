"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short, documents are long, so containment |item & doc| / |item|
over five-word shingles is searched, not resemblance. Items are partitioned by
the power of two of their number of shingles; a document with fewer runs of
words than the least match of a partition skips it. An item of n shingles is sketched by its s smallest
shingle hashes (a bottom-s MinHash sketch) with s = n - ceil(t * n) + 1. A
document that holds at least t * n of the shingles must hold one of any s of
them, so the search over the sketches loses nothing, whatever the size of the
document. Each candidate is verified on the spot by exact containment of the
shingles themselves.

The benchmark is searched in blocks of at most ``block_rows`` items and
``block_chars`` characters, and repeated items are sent once with their number.
Of several blocks one is searched after the other: what it found is written,
then its broadcast is destroyed, so the driver and a Python worker hold one
block whatever the size of the benchmark. With one block documents are never
shuffled; with several, the pipeline stage takes out the found row numbers by
one join.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Edge
cases: items of one to four words are one shingle, their whole sequence of
words; items and documents without words never match; null text is empty;
repeated items and documents are reported each; empty tables give an empty
result; extra columns are not read. A null document or item id is reported as
null.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.llm.common import Remembered, ship_package, text_or_empty, words
from retail_lake.operators.stages import stage

SHINGLE = 5
THRESHOLD = 0.8
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 16_000_000
_MULTIPLIERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(SHINGLE)], dtype=np.uint64)


def shingles(w: list[bytes], size: int) -> list[bytes]:
    return [b" ".join(w[i:i + size]) for i in range(len(w) - size + 1)]


class ItemIndex:
    """Sketches of one block of items, partitioned by shingle length and number of shingles."""

    def __init__(self, items: list[tuple[object, str, int]], threshold: float):
        self.word_hash = Remembered(xxhash.xxh64_intdigest, 200_000)
        self.items: list[tuple[object, frozenset, int, int]] = []
        partitions: dict[tuple[int, int], dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        least: dict[tuple[int, int], int] = {}
        for item_id, text, copies in items:
            w = words(text)
            if not w:
                continue
            size = min(SHINGLE, len(w))
            own = frozenset(shingles(w, size))
            need = math.ceil(threshold * len(own) - 1e-9)
            part = (size, len(own).bit_length())
            least[part] = min(need, least.get(part, need))
            hashes = np.unique(self.hashes(w, size))
            for h in hashes[:len(own) - need + 1].tolist():
                partitions[part][h].append(len(self.items))
            self.items.append((item_id, own, need, copies))
        #: shingle length -> [(least match, sorted sketch hashes, hash -> items)], one for each size class
        self.partitions: dict[int, list[tuple[int, np.ndarray, dict[int, list[int]]]]] = defaultdict(list)
        for part, p in sorted(partitions.items()):
            self.partitions[part[0]].append((least[part], np.array(sorted(p), dtype=np.uint64), dict(p)))

    def hashes(self, w: list[bytes], size: int) -> np.ndarray:
        """A 64-bit hash of each run of ``size`` words."""
        h = np.fromiter(map(self.word_hash.__getitem__, w), dtype=np.uint64, count=len(w))
        n = len(w) - size + 1
        total = np.zeros(n, dtype=np.uint64)
        for k in range(size):
            total += h[k:k + n] * _MULTIPLIERS[k]
        return total

    def contained(self, text: str) -> list[tuple[object, int, int, int]]:
        """(item id, shingles found, shingles of the item, its copies) of all items that the text holds."""
        w = words(text)
        found = []
        for size, classes in self.partitions.items():
            runs = len(w) - size + 1
            if runs < classes[0][0]:
                continue
            h = self.hashes(w, size)
            candidates: set[int] = set()
            for least, sketch, postings in classes:
                if runs >= least:
                    at = np.minimum(np.searchsorted(sketch, h), len(sketch) - 1)
                    candidates.update(i for x in np.unique(h[sketch[at] == h]).tolist() for i in postings[x])
            if candidates:
                own = set(shingles(w, size))
                for i in sorted(candidates):
                    item_id, item, need, copies = self.items[i]
                    matched = len(item & own)
                    if matched >= need:
                        found.append((item_id, matched, len(item), copies))
        return found


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> list[DataFrame]:
    """The benchmark, repeated items as one, in as many hash blocks as its size asks for."""
    items = benchmark.select(F.col(id_col).alias("item_id"), text_or_empty(text_col).alias("text"))
    items = stage(items.groupBy("item_id", "text").agg(F.count("*").alias("copies")), "items")
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    k = max(1, math.ceil(2 * n / BLOCK_ITEMS), math.ceil(2 * chars / BLOCK_CHARS))
    if k == 1:
        return [items]
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(k)) == b) for b in range(k)]


def contaminations(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_id_col: str = "item_id", item_text_col: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and item that it holds: id, item_id, matched, n_shingles, containment."""
    spark = docs.sparkSession
    ship_package(spark)
    item_type = benchmark.schema[item_id_col].dataType.simpleString()

    def found(shared) -> DataFrame:
        hits = _hits(shared, item_type)
        return (docs.select(F.col(id_col), hits(text_or_empty(text_col)).alias("__hits"))
                    .select(F.col(id_col), F.explode("__hits").alias("__hit"))
                    .select(F.col(id_col), "__hit.*", F.explode(F.expr("sequence(1L, __hit.copies)")).alias("__copy"))
                    .drop("copies", "__copy"))

    result = _searched(_blocks(benchmark, item_id_col, item_text_col), threshold, found, "contaminations")
    return result.withColumn("containment", F.col("matched") / F.col("n_shingles"))


def _searched(blocks: list[DataFrame], threshold: float, found: Callable[..., DataFrame], label: str) -> DataFrame:
    """What ``found`` gives for all blocks; of several, each is written and its broadcast destroyed before the next."""
    if len(blocks) == 1:
        return found(_shared(blocks[0], threshold))
    result = None
    for block in blocks:
        shared = _shared(block, threshold)
        part = stage(found(shared), label)
        shared.destroy()
        result = part if result is None else result.unionByName(part)
    return result


def _shared(block: DataFrame, threshold: float):
    """Broadcast of one bounded block of items."""
    rows = sorted(((r.item_id, r.text, r.copies) for r in block.toLocalIterator()), key=str)
    return block.sparkSession.sparkContext.broadcast((rows, threshold))


def _hits(shared, item_type: str):
    @F.pandas_udf(f"array<struct<item_id:{item_type},matched:bigint,n_shingles:bigint,copies:bigint>>")
    def hits(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, names = ItemIndex(*shared.value), ("item_id", "matched", "n_shingles", "copies")
        for batch in texts:
            yield pd.Series([[dict(zip(names, hit, strict=True)) for hit in index.contained(t)]
                             for t in batch], dtype=object)

    return hits.asNondeterministic()                         # in name only: explode would else run it twice


def _holds(shared):
    @F.pandas_udf("boolean")
    def holds(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = ItemIndex(*shared.value)
        for batch in texts:
            yield pd.Series([bool(index.contained(t)) for t in batch], dtype=bool)

    return holds


def keep_clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pipeline stage: documents that hold no benchmark item, columns unchanged."""
    ship_package(docs.sparkSession)
    blocks = _blocks(benchmark, "item_id", "text")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc")
    if len(blocks) == 1:
        kept = docs.select(whole, text_or_empty("text").alias("__t"))
        return kept.where(~_holds(_shared(blocks[0], threshold))("__t")).select("__doc.*")
    rows = stage(docs.select(whole, F.monotonically_increasing_id().alias("__row")), "to-clean")
    texts = rows.select("__row", F.coalesce(F.col("__doc.text").cast("string"), F.lit("")).alias("__t"))
    dirty = _searched(blocks, threshold, lambda shared: texts.where(_holds(shared)("__t")).select("__row"), "dirty")
    return rows.join(dirty.distinct(), "__row", "left_anti").select("__doc.*")


#: The same search by brute force over all shingles.
ORACLE_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_shingles AS (
  SELECT DISTINCT item_id, least(5, len(w)) AS size,
         unnest(list_transform(range(1, len(w) - least(5, len(w)) + 2),
                lambda i: array_to_string(w[i:i + least(5, len(w)) - 1], ' '))) AS s
  FROM item_words WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM item_shingles),
doc_shingles AS (
  SELECT DISTINCT doc_id, size,
         unnest(list_transform(range(1, len(w) - size + 2),
                lambda i: array_to_string(w[i:i + size - 1], ' '))) AS s
  FROM doc_words, sizes WHERE len(w) >= size),
totals AS (SELECT item_id, count(*) AS n_shingles FROM item_shingles GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS matched, any_value(n_shingles) AS n_shingles,
       count(*) / any_value(n_shingles) AS containment
FROM item_shingles JOIN doc_shingles USING (size, s) JOIN totals USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(n_shingles) - 1e-9
"""
