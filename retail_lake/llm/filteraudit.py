"""Audit of how document filters interact, over a sparse document-term matrix.

Five filters fail a document (words: maximal ``[^\\x20\\x09-\\x0D]+``, case-sensitive):
A under 200 words, B fewer than half of the words distinct, C over 2 % of the
code points in A-Z, D any of ``#$%&*|``, E the text of a smaller id.

The matrix is built in shards of documents (compressed sparse rows). A first pass
over the texts writes every shard with a vocabulary of its own. The vocabularies, cut into
blocks by the words' hash, are shuffled to dictionary buckets; a bucket sees all
shards' blocks of its words and gives each distinct word one id (its number in the
bucket times the number of buckets, plus the bucket's). Back at their shards the
ids replace the local column indices. Row sums of the finished matrix are word
counts, its row lengths (nonzero counts) distinct words: they decide A and B. C and D come
from the first pass, E from the smallest id of each text digest (SHA-256).
``document_flags`` joins them; ``audit_filters`` counts the 32 failure patterns
per part, from which every order's figures follow without looking at a document again.

What a task holds is one shard (SHARD_BYTES of text or SHARD_ROWS documents,
whichever comes first, or one longer document) or one bucket (about BUCKET_WORDS
entries: there are as many buckets as the vocabularies need). A word in every
shard costs one entry a shard, a text shared by many documents one row a map task.

Edge cases: null text is the empty text (fails A; not B, as 0 < 0 is false; not
C); empty texts are identical to each other; rows of equal id and text are both
kept and neither is a copy of the other; a null id is no smaller id and has
none; null source is the part ''; a document without label loses nothing, and of
several label rows any 1 counts; parts with documents get all 600 rows, zeros
included; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count, permutations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.llm.common import ship_package, text_or_empty
from retail_lake.operators.stages import stage

#: Filters in bit order, and their limits.
FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 200, 50, 2
_SYMBOL = re.compile(rb"[#$%&*|]")
_UPPER = bytes(range(0x41, 0x5B))

SHARD_ROWS, SHARD_BYTES = 10_000, 16 << 20     # bound a task's memory, not results
BUCKET_WORDS = 200_000

_SHARD = ("doc_ids array<bigint>, parts array<string>, upper array<boolean>, symbol array<boolean>, "
          "digests array<binary>, row_ends binary, columns binary, counts binary, vocabulary binary, n_vocabulary bigint")
_SHARD_ARROW = pa.schema([
    ("doc_ids", pa.list_(pa.int64())), ("parts", pa.list_(pa.string())), ("upper", pa.list_(pa.bool_())),
    ("symbol", pa.list_(pa.bool_())), ("digests", pa.list_(pa.binary())), ("row_ends", pa.binary()),
    ("columns", pa.binary()), ("counts", pa.binary()), ("vocabulary", pa.binary()), ("n_vocabulary", pa.int64())])


def _pack(a: np.ndarray | bytes) -> bytes:
    return zstandard.compress(a if isinstance(a, bytes) else a.tobytes(), 3)


def _unpack(b: bytes, dtype: str | None = None):
    raw = zstandard.decompress(b)
    return raw if dtype is None else np.frombuffer(raw, dtype=dtype)


def _one_row(values: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)


class _Shard:
    """One block of documents: their rows of the matrix and the flags read from the text."""

    def __init__(self):
        self.number = defaultdict(count().__next__)           # word -> local column
        self.doc_ids, self.parts, self.upper, self.symbol, self.digests = [], [], [], [], []
        self.ends, self.columns, self.counts, self.nnz, self.bytes = [], [], [], 0, 0

    def add(self, doc_id, part, text: str) -> None:
        raw = text.encode("utf-8", "replace")
        words = Counter(raw.split())                          # bytes split at 0x20 and 0x09-0x0D only
        self.columns.append(np.fromiter(map(self.number.__getitem__, words), dtype="<i4", count=len(words)))
        self.counts.append(np.fromiter(words.values(), dtype="<i4", count=len(words)))
        self.nnz += len(words)
        self.ends.append(self.nnz)
        self.doc_ids.append(doc_id)
        self.parts.append(part)
        capitals = len(raw) - len(raw.translate(None, _UPPER))
        self.upper.append(100 * capitals > UPPER_PERCENT * len(text))
        self.symbol.append(_SYMBOL.search(raw) is not None)
        self.digests.append(hashlib.sha256(raw).digest())
        self.bytes += len(raw)

    def batch(self) -> pa.RecordBatch:
        words = list(self.number)                             # words hold no space: it can stand between them
        return _one_row([self.doc_ids, self.parts, self.upper, self.symbol, self.digests,
                         _pack(np.array(self.ends, dtype="<i8")), _pack(np.concatenate(self.columns)),
                         _pack(np.concatenate(self.counts)), _pack(b" ".join(words)), len(words)], _SHARD_ARROW)


def local_shards(documents: DataFrame) -> DataFrame:
    """Shards of the matrix with columns numbered by each shard's own vocabulary."""
    ship_package(documents.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for b in batches:
            for doc_id, part, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                shard.add(doc_id, part, text)
                if shard.bytes >= SHARD_BYTES or len(shard.ends) >= SHARD_ROWS:
                    yield shard.batch()
                    shard = _Shard()
        if shard.ends:
            yield shard.batch()

    rows = documents.select(F.col("doc_id").cast("bigint"), text_or_empty("source"), text_or_empty("text"))
    return rows.mapInArrow(cut, _SHARD).withColumn("shard", F.monotonically_increasing_id())


def _vocabulary_blocks(shards: DataFrame, buckets: int) -> DataFrame:
    """A row per shard and dictionary bucket: the words of that bucket and their local columns."""
    schema = pa.schema([("bucket", pa.int32()), ("shard", pa.int64()), ("local", pa.binary()), ("words", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, packed, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not n:
                    continue
                words = _unpack(packed).split(b" ")
                bucket = np.fromiter(map(zlib.crc32, words), dtype="<u4", count=n) % np.uint32(buckets)
                order = np.argsort(bucket, kind="stable").astype("<i4")
                firsts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                rows = [(int(bucket[own[0]]), shard, _pack(own), _pack(b" ".join([words[i] for i in own])))
                        for own in np.split(order, firsts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in
                                                  zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return shards.select("shard", "vocabulary", "n_vocabulary").mapInArrow(
        cut, "bucket int, shard bigint, local binary, words binary")


def dictionary_ids(shards: DataFrame) -> DataFrame:
    """Global word ids of the shards' local columns, in blocks: shard, local (packed int32), ids (packed int64)."""
    entries = shards.agg(F.sum("n_vocabulary")).first()[0] or 0
    buckets = int(max(1, -(-entries // BUCKET_WORDS)))

    def number(blocks: pa.Table) -> pa.Table:
        ids = defaultdict(count().__next__)
        bucket, out = blocks.column("bucket")[0].as_py(), []
        for words in blocks.column("words").to_pylist():
            words = _unpack(words).split(b" ")
            out.append(_pack(np.fromiter(map(ids.__getitem__, words), dtype="<i8", count=len(words)) * buckets + bucket))
        return pa.table({"shard": blocks.column("shard"), "local": blocks.column("local"), "ids": pa.array(out, pa.binary())})

    return _vocabulary_blocks(shards, buckets).groupBy("bucket").applyInArrow(number, "shard bigint, local binary, ids binary")


_MATRIX_ARROW = pa.schema([*list(_SHARD_ARROW)[:8], ("shard", pa.int64())])
_MATRIX = _SHARD.split(", vocabulary")[0] + ", shard bigint"


def document_term_matrix(documents: DataFrame) -> DataFrame:
    """The matrix in CSR shards, arrays compressed: ``columns`` are global word ids (int64), ``counts`` their numbers
    (int32), ``row_ends`` the ends of the documents' rows (int64); per document its id, part and text flags."""
    shards = stage(local_shards(documents), "shards")

    def rewrite(shard: pa.Table, blocks: pa.Table) -> pa.Table:
        row = shard.to_pylist()[0]
        known = np.zeros(row["n_vocabulary"], dtype="<i8")
        for local, ids in zip(blocks.column("local").to_pylist(), blocks.column("ids").to_pylist(), strict=True):
            known[_unpack(local, "<i4")] = _unpack(ids, "<i8")
        row["columns"] = _pack(known[_unpack(row["columns"], "<i4")])
        return pa.Table.from_batches([_one_row([row[f.name] for f in _MATRIX_ARROW], _MATRIX_ARROW)])

    # one shard with the ids of its own words, whatever the number of documents
    return shards.drop("vocabulary").groupBy("shard").cogroup(dictionary_ids(shards).groupBy("shard")).applyInArrow(
        rewrite, _MATRIX)


def matrix_rows(matrix: DataFrame) -> DataFrame:
    """Per document: id, part, text digest, word count (row sum), distinct words (nonzero count), C and D."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ends = _unpack(r["row_ends"], "<i8")
                total = np.concatenate([[0], np.cumsum(_unpack(r["counts"], "<i4"), dtype="<i8")])
                starts = np.concatenate([[0], ends[:-1]])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(r["doc_ids"], pa.int64()), "part": pa.array(r["parts"], pa.string()),
                    "digest": pa.array(r["digests"], pa.binary()), "n_words": total[ends] - total[starts],
                    "n_distinct": ends - starts, "upper": r["upper"], "symbol": r["symbol"]})

    return matrix.select("doc_ids", "parts", "digests", "row_ends", "counts", "upper", "symbol").mapInArrow(
        sums, "doc_id bigint, part string, digest binary, n_words bigint, n_distinct bigint, upper boolean, symbol boolean")


def document_flags(documents: DataFrame) -> DataFrame:
    """Per document: id, part, n_words, n_distinct, and whether each filter fails it (columns A to E)."""
    rows = stage(matrix_rows(document_term_matrix(documents)), "matrix_rows")
    # the first id of each text that several documents have; one row a text
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.join(first.select("digest", "first_id"), "digest", "left").selectExpr(
        "doc_id", "part", "n_words", "n_distinct", f"n_words < {MIN_WORDS} as A",
        f"100 * n_distinct < {DISTINCT_PERCENT} * n_words as B", "upper as C", "symbol as D",
        "coalesce(doc_id > first_id, false) as E")


def audit_filters(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: what the filter keeps, removes and loses there."""
    bits = " + ".join(f"cast({f} as int) * {1 << i}" for i, f in enumerate(FILTERS))
    judged = labels.groupBy("doc_id").agg(F.expr("coalesce(max(int(quality = 1)), 0) as good"),
                                          F.expr("coalesce(max(int(toxic = 1)), 0) as toxic"))
    flagged = document_flags(documents).selectExpr("doc_id", "part", f"{bits} as failed").join(judged, "doc_id", "left")
    patterns = flagged.groupBy("part", "failed").agg(
        F.expr("count(*) as n"), F.expr("coalesce(sum(good), 0) as good"), F.expr("coalesce(sum(toxic), 0) as toxic"))
    # at most 32 patterns a part
    parts = patterns.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("seen"))
    orders = ", ".join(f"'{''.join(p)}'" for p in permutations(FILTERS))
    steps = parts.selectExpr("part", "seen", f"explode(array({orders})) as filter_order").selectExpr(
        "*", f"explode(sequence(1, {len(FILTERS)})) as step")
    bit_of = " ".join(f"when '{f}' then {1 << i}" for i, f in enumerate(FILTERS))
    steps = steps.withColumn("own", F.expr(f"case substr(filter_order, step, 1) {bit_of} end")).withColumn(
        "before", F.expr(f"aggregate(sequence(0, step - 1), 0, (b, i) -> if(i = 0, b, "
                         f"b | case substr(filter_order, i, 1) {bit_of} end))"))

    def total(value: str, where: str) -> str:
        return f"aggregate(filter(seen, s -> {where}), 0L, (t, s) -> t + {value})"

    here = "s.failed & own != 0 and s.failed & before = 0"
    orders_total = len(list(permutations(FILTERS)))
    return steps.selectExpr(
        "part", "filter_order", "step", f"{total('s.n', 's.failed & (own | before) = 0')} as kept",
        f"{total('s.n', here)} as removed", f"{total('s.n', 's.failed & own != 0 and s.failed & before != 0')} as redundant",
        f"{total('s.n', 's.failed = own')} as unique_fails", f"{total('s.good', here)} as good_lost",
        f"{total('s.toxic', here)} as toxic_lost",
        # a document falls to each filter that it fails in an equal share of all orders
        f"{total(f's.n * ({orders_total} div bit_count(s.failed))', 's.failed & own != 0')} as shapley")


def _oracle() -> str:
    """DuckDB: flags by the rules on lists of words, every order walked through document by document pattern."""
    return r"""
WITH judged AS (
  SELECT doc_id, max(coalesce((quality = 1)::INT, 0)) AS good, max(coalesce((toxic = 1)::INT, 0)) AS toxic
  FROM labels GROUP BY doc_id),
texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
flags AS (
  SELECT doc_id, part, (len(words) < 200)::INT AS a, (100 * len(list_distinct(words)) < 50 * len(words))::INT AS b,
         (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text))::INT AS c,
         regexp_matches(text, '[#$%&*|]')::INT AS d,
         coalesce((doc_id > min(doc_id) OVER (PARTITION BY text))::INT, 0) AS e FROM texts),
patterns AS (
  SELECT part, map(['A', 'B', 'C', 'D', 'E'], [a, b, c, d, e]) AS fails, a + b + c + d + e AS n_fails, count(*) AS n,
         sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM flags LEFT JOIN judged USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT l1.f || l2.f || l3.f || l4.f || l5.f AS filter_order
  FROM letters l1, letters l2, letters l3, letters l4, letters l5
  WHERE len(list_distinct([l1.f, l2.f, l3.f, l4.f, l5.f])) = 5),
steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
walked AS (
  SELECT part, filter_order, step, n, good, toxic, n_fails, fails[filter_order[step]] AS own,
         list_sum(list_transform(range(1, step), lambda i: fails[filter_order[i]])) AS earlier, filter_order[step] AS f
  FROM patterns, steps),
summed AS (
  SELECT part, filter_order, step, f, sum(n) FILTER (own = 0 AND coalesce(earlier, 0) = 0) AS kept,
         sum(n) FILTER (own = 1 AND coalesce(earlier, 0) = 0) AS removed,
         sum(n) FILTER (own = 1 AND earlier > 0) AS redundant, sum(n) FILTER (own = 1 AND n_fails = 1) AS unique_fails,
         sum(good) FILTER (own = 1 AND coalesce(earlier, 0) = 0) AS good_lost,
         sum(toxic) FILTER (own = 1 AND coalesce(earlier, 0) = 0) AS toxic_lost
  FROM walked GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       sum(coalesce(removed, 0)) OVER (PARTITION BY part, f)::BIGINT AS shapley
FROM summed"""


ORACLE_SQL = _oracle()
