"""Approximate nearest neighbours by stable projections and kd-trees.

Vectors of length one are projected to ``PROJECTED`` dimensions by Gaussian
(2-stable) directions. The squared projected distance of two vectors over
their squared true distance follows a chi-square law, so a search that meets
candidates in ascending projected distance may stop once a closer vector
beyond that distance is improbable. The fewer the dimensions, the wider the law: 32 keep
it narrow enough to stop early on vectors that are all far from one another.

A kd-tree fitted on a bounded sample cuts the projected space into cells; all
vectors are dealt to cells, large cells to sub-blocks of at most about
``CELL_ROWS`` rows, so no task holds more. Each query first searches its home
cell; the distance of its k-th neighbour there bounds the second round, which
visits every cell whose box passes the chi-square test. Inside a block a local
kd-tree yields its leaves by the distance of their boxes, the points of the leaves by their own
projected distance; a point is verified by exact cosine only while the test does not hold
for it. A point that is passed over lay beyond the test's distance then, and that distance only shrinks.

The queries sent to a cell are dealt in parts of about ``QUERY_ROWS``. Of identical vectors only the
k + 1 smallest ids are indexed: any other has k better ones by the tie rule.
Identical queries are searched once.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components and rows without id take no part; vectors are compared with
vectors of their own dimension only; ties go to the smaller id; fewer than k
candidates are all returned; empty tables give an empty result; extra columns
are not read. Vectors are scaled by a power of two of their own before they are squared, which
changes no digit of a cosine, so very large and very small components neither overflow nor vanish.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_lake.llm.common import ship_package
from retail_lake.operators.stages import stage

PROJECTED = 32
CONFIDENCE = 0.93          # of the stopping test; recall on given vectors is measured in tests
SAMPLE_ROWS = 4096
CELL_ROWS = 20_000
QUERY_ROWS = 50_000
LEAF = 256
ROUNDING = 1e-9            # projections of parallel vectors differ by rounding alone
FIRST_VERIFIED = 32        # points verified at once, doubled from step to step


def chi_square_cdf(x: np.ndarray, m: int = PROJECTED) -> np.ndarray:
    """Chi-square distribution function for an even number of degrees."""
    half = np.minimum(np.asarray(x, dtype=np.float64) / 2, 700)
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, m // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def stop_ratio(confidence: float = CONFIDENCE, m: int = PROJECTED) -> float:
    """Squared projected over squared true distance at which the test holds."""
    lo, hi = 0.0, 1000.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_cdf(np.array(mid), m) < confidence else (lo, mid)
    return hi


def directions(dim: int, m: int = PROJECTED) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim, m))


def kd_cells(points: np.ndarray, leaf: int) -> np.ndarray:
    """Leaf number of every point: median cuts of the widest dimension until leaves hold at most ``leaf``."""
    cell = np.zeros(len(points), dtype=np.int64)
    todo, done = [np.arange(len(points))], 0
    while todo:
        rows = todo.pop()
        own = points[rows]
        widths = own.max(axis=0) - own.min(axis=0) if len(rows) else np.zeros(1)
        if len(rows) <= leaf or not widths.max() > 0:
            cell[rows] = done
            done += 1
            continue
        order = rows[np.argsort(own[:, widths.argmax()], kind="stable")]
        todo += [order[len(order) // 2:], order[:len(order) // 2]]
    return cell


class CellTree:
    """Axis cuts fitted on a sample; says in which cell a projected vector lies."""

    def __init__(self, points: np.ndarray, cells: int):
        self.cuts: list[tuple[int, float, int, int] | int] = []       # (axis, value, left, right) or cell
        self.n = 0
        self._grow(points, cells)

    def _grow(self, points: np.ndarray, cells: int) -> int:
        at = len(self.cuts)
        self.cuts.append(-1)
        if cells > 1 and len(points) >= 2:
            axis = int((points.max(axis=0) - points.min(axis=0)).argmax())
            value = float(np.median(points[:, axis]))
            left = points[:, axis] < value
            if left.any() and not left.all():
                a = self._grow(points[left], cells // 2)
                b = self._grow(points[~left], cells - cells // 2)
                self.cuts[at] = (axis, value, a, b)
                return at
        self.cuts[at] = self.n
        self.n += 1
        return at

    def cell(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), dtype=np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            at, rows = todo.pop()
            cut = self.cuts[at]
            if isinstance(cut, int):
                out[rows] = cut
                continue
            axis, value, a, b = cut
            left = points[rows, axis] < value
            todo += [(a, rows[left]), (b, rows[~left])]
        return out


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Rows scaled by powers of two, so that their largest component lies in [0.5, 1)."""
    x = np.array(vectors.tolist(), dtype=np.float64)
    if not x.size:
        return x
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Block:
    """Vectors of one block, sorted by the leaves of a kd-tree over their projections."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        norms = np.sqrt((x * x).sum(axis=1))
        p = (x / norms[:, None]) @ directions(x.shape[1])
        leaf_of = kd_cells(p, LEAF)
        order = np.lexsort((ids, leaf_of))
        self.ids, self.x, self.norms, self.p = ids[order], x[order], norms[order], p[order]
        self.squares = (self.p * self.p).sum(axis=1)
        cuts = np.flatnonzero(np.diff(leaf_of[order])) + 1
        self.starts, self.ends = np.append(0, cuts), np.append(cuts, len(ids))
        self.lo, self.hi = np.minimum.reduceat(self.p, self.starts), np.maximum.reduceat(self.p, self.starts)

    def search(self, q: np.ndarray, k: int, ratio: float, limit: float) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and cosines of the k best, and how many points were verified; ``limit``: the squared true
        distance of a k-th best known from elsewhere."""
        norm = math.sqrt(float((q * q).sum()))
        pq = (q / norm) @ directions(len(q))
        far = (np.maximum(0, np.maximum(self.lo - pq, pq - self.hi)) ** 2).sum(axis=1)
        leaves = np.argsort(far, kind="stable")
        best_ids, best, verified = np.zeros(0, dtype=np.int64), np.zeros(0), 0
        at, step = 0, 1
        while at < len(leaves) and far[leaves[at]] <= ratio * limit + ROUNDING:
            group, at, step = leaves[at:at + step], at + step, 2 * step
            group = group[far[group] <= ratio * limit + ROUNDING]
            rows = np.concatenate([np.arange(self.starts[leaf], self.ends[leaf]) for leaf in group])
            away = np.maximum(0, self.squares[rows] - 2 * (self.p[rows] @ pq) + pq @ pq)
            near = np.flatnonzero(away <= ratio * limit + ROUNDING)
            near = near[np.argsort(away[near], kind="stable")]
            rows, away = rows[near], away[near]
            done, chunk = 0, FIRST_VERIFIED
            while done < len(rows) and away[done] <= ratio * limit + ROUNDING:
                stop = min(done + chunk, int(np.searchsorted(away, ratio * limit + ROUNDING, side="right")))
                own = rows[done:stop]
                score = (self.x[own] * q).sum(axis=1) / (self.norms[own] * norm)
                best_ids, best = np.concatenate([best_ids, self.ids[own]]), np.concatenate([best, score])
                if len(best) > k:
                    top = np.lexsort((best_ids, -best))[:k]
                    best_ids, best = best_ids[top], best[top]
                if len(best) == k:
                    limit = min(limit, max(0.0, 2 - 2 * best.min()))
                verified, done, chunk = verified + len(own), stop, 2 * chunk
        return best_ids, best, verified


def search_block(rows: pd.DataFrame, queries: pd.DataFrame, k: int, ratio: float) -> pd.DataFrame:
    """The k best of one block for each query: (qid, vec_id, score)."""
    block = Block(rows["vec_id"].to_numpy(), _matrix(rows["vec"]))
    out = []
    for qid, q, bound in zip(queries["qid"].to_numpy(), _matrix(queries["vec"]), queries["bound"].to_numpy(), strict=True):
        ids, score, _ = block.search(q, k, ratio, bound)
        out.append(pd.DataFrame({"qid": qid, "vec_id": ids, "score": score}))
    return (pd.concat(out, ignore_index=True) if out
            else pd.DataFrame({"qid": [], "vec_id": [], "score": []})).astype({"qid": "int64", "vec_id": "int64"})


def _searched(index: DataFrame, asked: DataFrame, cells: DataFrame, k: int, ratio: float) -> DataFrame:
    """Search every block of the cells that queries are sent to; asked: qid, vec, bound, cell.

    A cell's queries are dealt to parts of about ``QUERY_ROWS``, and only such
    a cell's rows are copied, once for each of its parts.
    """
    parts = asked.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_ROWS).alias("parts"))
    parts = F.broadcast(cells.join(parts, "cell"))           # as many rows as cells
    index = (index.join(parts.select("cell", "parts"), "cell")
                  .withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)"))))
    asked = (asked.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("qid"), F.col("parts")))
                  .withColumn("sub", F.explode(F.expr("sequence(0L, cast(subs - 1 as bigint))"))))
    keys = ["cell", "sub", "part"]

    def both(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(queries):
            return pd.DataFrame({"qid": [], "vec_id": [], "score": []})
        return search_block(rows, queries, k, ratio)

    return (index.select(*keys, "vec_id", "vec").groupBy(*keys)
            .cogroup(asked.select(*keys, "qid", "vec", "bound").groupBy(*keys))
            .applyInPandas(both, "qid bigint, vec_id bigint, score double"))


def nearest_neighbours(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
                       vec_col: str = "embedding", confidence: float = CONFIDENCE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each query by cosine."""
    spark, ratio, want = df.sparkSession, stop_ratio(confidence), k + 1      # a query finds itself
    ship_package(spark)
    usable = F.expr("size(vec) > 0 and not exists(vec, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
                    " and exists(vec, x -> x <> 0)")
    rows = (df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).alias("vec"), is_query.alias("asks"))
              .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).where(usable))
    queries = rows.where("asks").select(F.col("vec_id").alias("query_id"), "vec")
    copies = Window.partitionBy("vec").orderBy("vec_id")
    held = rows.select("vec_id", "vec").withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= want + 1)
    held = stage(held.drop("copy"), "vectors")

    # cells from a bounded sample, spread by a hash of the id
    n = held.count()
    share = min(1.0, SAMPLE_ROWS / max(n, 1))
    sample = (held.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
                  .select("vec").limit(2 * SAMPLE_ROWS).toPandas()["vec"])
    trees = {}
    for dim in {len(v) for v in sample}:
        own = _unit(_matrix(sample[[len(v) == dim for v in sample]])) @ directions(dim)
        trees[dim] = CellTree(own, max(1, min(len(own) // 16, math.ceil(n / CELL_ROWS))))
    first = {}
    for dim in sorted(trees):                                # cell numbers of the dimensions one after another
        first[dim] = sum(trees[d].n for d in first)
    spare = sum(t.n for t in trees.values())                 # dimensions outside the sample: a cell of their own
    shared = spark.sparkContext.broadcast((trees, first, spare))

    @F.pandas_udf("struct<cell:bigint,p:array<double>>")
    def located(vectors: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        trees, first, spare = shared.value
        for batch in vectors:
            dims = np.array([len(v) for v in batch])
            cell, p = np.zeros(len(batch), dtype=np.int64), np.zeros((len(batch), PROJECTED))
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                p[own] = _unit(_matrix(batch.iloc[own])) @ directions(dim)
                cell[own] = trees[dim].cell(p[own]) + first[dim] if dim in trees else spare + dim
            yield pd.DataFrame({"cell": cell, "p": list(p)})

    placed = held.withColumn("at", located("vec").alias("at")).select("vec_id", "vec", "at.cell", "at.p")
    placed = stage(placed, "placed")
    boxes = (placed.groupBy("cell").agg(F.count("*").alias("n"),
             F.array(*[F.min(F.col("p")[i]) for i in range(PROJECTED)]).alias("lo"),
             F.array(*[F.max(F.col("p")[i]) for i in range(PROJECTED)]).alias("hi"))
             .orderBy("cell").collect())                     # one row per cell
    subs = {b.cell: math.ceil(b.n / CELL_ROWS) for b in boxes}
    box = spark.sparkContext.broadcast(([b.cell for b in boxes], np.array([b.lo for b in boxes]).reshape(-1, PROJECTED),
                                        np.array([b.hi for b in boxes]).reshape(-1, PROJECTED)))
    cells = spark.createDataFrame([(c, s) for c, s in subs.items()], "cell bigint, subs int")
    index = (placed.join(F.broadcast(cells), "cell")         # as many rows as cells
                   .withColumn("sub", F.pmod(F.xxhash64("vec_id"), F.col("subs"))).select("cell", "sub", "vec_id", "vec"))

    searched = queries.groupBy("vec").agg(F.min("query_id").alias("qid"))
    asked = stage(searched.withColumn("at", located("vec")).select("qid", "vec", "at.cell", "at.p"), "asked")
    home = asked.select("qid", "vec", F.lit(float("inf")).alias("bound"), "cell")
    home = stage(_searched(index, home, cells, want, ratio), "home")
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    bound = (home.withColumn("r", F.row_number().over(best)).where(F.col("r") == want)
                 .select("qid", F.greatest(F.lit(0.0), 2 - 2 * F.col("score")).alias("bound")))

    @F.pandas_udf("array<bigint>")
    def other_cells(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        names, lo, hi = box.value
        names = np.array(names)
        for home_cell, dim, p, bound_ in parts:
            trees, first, spare = shared.value
            out = []
            for c, d, q, b in zip(home_cell, dim, p, bound_, strict=True):
                far = (np.maximum(0, np.maximum(lo - q, q - hi)) ** 2).sum(axis=1)
                own = (names >= first[d]) & (names < first[d] + trees[d].n) if d in trees else names == spare + d
                out.append(names[own & (far <= ratio * b + ROUNDING) & (names != c)].tolist())
            yield pd.Series(out, dtype=object)

    again = stage(asked.join(bound, "qid", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
                       .withColumn("more", other_cells("cell", F.size("vec"), "p", "bound"))
                       .select("qid", "vec", "bound", F.explode("more").alias("cell")), "again")
    found = home.unionByName(_searched(index, again, cells, want, ratio))
    top = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= want).drop("r")
    names = queries.join(searched, "vec").select("query_id", "qid")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (names.join(top, "qid").where("vec_id <> query_id").withColumn("rank", F.row_number().over(own))
                 .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def embedding_neighbours(embeddings: DataFrame) -> DataFrame:
    """The five nearest of every 50th vector."""
    return nearest_neighbours(embeddings, F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False)))
