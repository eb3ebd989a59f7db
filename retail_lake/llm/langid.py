"""Language identification in two levels.

A text is first given a language family (one-versus-rest linear support vector
machines over the families), then one-versus-one linear support vector
machines between the languages of that family vote. Features are hashed
1- to 3-byte grams of the whole text, square-rooted and scaled to length one.

Training uses a bounded sample of labelled rows: at most ``rows_per_lang``
rows of each of the LABELS most frequent labels (ties by name) and TRAIN_ROWS in all, in equal shares
once the labels outnumber the known languages. Rarer labels of a dirty column are not learnt, so the
sample, the number of machines and their weights are bounded whatever the column holds. A language's rows are the row with the smallest content hash of each of that
many hash buckets, so repeated rows count once and the choice does not depend
on partitioning. Everything else (prediction) covers every whole text.

Edge cases: null text or a text without letters is ``und`` with score 0; rows
without a label or with null text are never learnt from; with one learned
language everything else is that language; with none everything is ``und``
with score 0; ties between languages go to the alphabetically first; a null
document id counts as the empty text when folds are dealt (held out); an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from retail_lake.llm.common import ship_package, text_or_empty

DIMENSIONS = 4096
ROWS_PER_LANG = 600
#: Language codes by family; any other label is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
}
#: Rows of all languages together: the full share for every known language, whatever the number of labels.
TRAIN_ROWS = ROWS_PER_LANG * sum(map(len, FAMILIES.values()))
#: Labels that are learnt at most: the known languages and as many more.
LABELS = 100
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}
#: Letters and non-ASCII bytes stand for themselves, everything else is a space.
_BYTES = np.frombuffer(bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in bytes(range(256)).lower()),
                       dtype=np.uint8).astype(np.uint32)
_STEP = 1 << 20            # bytes per slice of a long text; grams across slices are kept


def family_of(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0], f"other:{lang}")


def has_letter(text: str) -> bool:
    """Any character of the Unicode categories L*; numeric signs (superscripts, fractions, Roman numerals) are none."""
    return any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """Hashed gram counts of the whole text, square-rooted, length one."""
    counts = np.zeros(DIMENSIONS)
    raw = text.encode("utf-8", "replace")
    for at in range(0, len(raw), _STEP):
        a = _BYTES[np.frombuffer(raw, dtype=np.uint8)[max(0, at - 2):at + _STEP]]
        seen = min(at, 2)                                    # bytes repeated from the slice before
        for n, factor in ((1, 0x9E3779B1), (2, 0x85EBCA77), (3, 0xC2B2AE3D)):
            if len(a) < n:
                continue
            code = a[n - 1:].copy()
            for back in range(1, n):
                code |= a[n - 1 - back:len(a) - back] << np.uint32(8 * back)
            code = code[max(0, seen - n + 1):]
            slots = (code * np.uint32(factor)) >> np.uint32(32 - DIMENSIONS.bit_length() + 1)
            counts += np.bincount(slots, minlength=DIMENSIONS)
    counts[(0x20 * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - DIMENSIONS.bit_length() + 1)] = 0      # lone spaces
    np.sqrt(counts, out=counts)
    norm = np.sqrt(counts @ counts)
    return counts / norm if norm else counts


def with_offset(vectors: list[bytes]) -> np.ndarray:
    """Training rows with a last column of ones; four bytes a value, as the vectors travel in two."""
    x = np.ones((len(vectors), DIMENSIONS + 1), dtype=np.float32)
    for i, v in enumerate(vectors):
        x[i, :-1] = np.frombuffer(v, dtype="<f2")
    return x


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, passes: int = 12) -> np.ndarray:
    """Weights (last one: offset) of an L2-loss linear support vector machine by dual coordinate descent.

    Rows with ``y`` 0 take no part. ``x`` is neither copied nor squared as a whole."""
    own = np.flatnonzero(y)
    squares = np.array([x[i].astype(np.float64) @ x[i] for i in own]) + 0.5 / c
    alpha, w = np.zeros(len(own)), np.zeros(x.shape[1])
    order = np.random.default_rng(0)
    for _ in range(passes):
        for n in order.permutation(len(own)):
            i = own[n]
            row = x[i].astype(np.float64)
            slope = y[i] * (w @ row) - 1 + 0.5 / c * alpha[n]
            new = max(0.0, alpha[n] - slope / squares[n])
            if new != alpha[n]:
                w += (new - alpha[n]) * y[i] * row
                alpha[n] = new
    return w


class LanguageModel:
    """Family machines and the pairwise machines inside each family."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        families = np.array([family_of(lang) for lang in langs])
        langs = np.array(langs)
        self.families = sorted(set(families))
        self.members = {f: [lang for lang in self.langs if family_of(lang) == f] for f in self.families}
        self.family_w = (np.array([linear_svm(x, np.where(families == f, 1.0, -1.0)) for f in self.families])
                         if len(self.families) > 1 else None)
        self.pair_w: dict[str, np.ndarray] = {}
        self.pairs: dict[str, list[tuple[int, int]]] = {}
        for f, members in self.members.items():
            self.pairs[f] = list(combinations(range(len(members)), 2))
            weights = []
            for i, j in self.pairs[f]:
                weights.append(linear_svm(x, np.where(langs == members[i], 1.0, 0.0) - np.where(langs == members[j], 1.0, 0.0)))
            self.pair_w[f] = np.array(weights)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not text or not has_letter(text):
            return "und", 0.0
        v = np.append(features(text), 1.0)
        family, score = self.families[0], 1.0
        if self.family_w is not None:
            p = _logistic(2 * (self.family_w @ v))
            best = int(np.argmax(p))
            family, score = self.families[best], float(p[best] / p.sum())
        members = self.members[family]
        if len(members) == 1:
            return members[0], score
        votes, sure = np.zeros(len(members)), np.zeros(len(members))
        for (i, j), p in zip(self.pairs[family], _logistic(2 * (self.pair_w[family] @ v)), strict=True):
            votes[i if p >= 0.5 else j] += 1
            sure[i] += p
            sure[j] += 1 - p
        sure /= len(members) - 1
        best = max(range(len(members)), key=lambda k: (votes[k], sure[k], -k))
        return members[best], score * float(sure[best])


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def held_out(id_col: str = "doc_id") -> Column:
    """The fold that is never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rows_per_lang: int = ROWS_PER_LANG) -> LanguageModel:
    """Fit on at most ``rows_per_lang`` rows of each of LABELS languages, TRAIN_ROWS in all, outside the held-out fold."""
    ship_package(df.sparkSession)
    rows = (df.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
              .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
              .withColumn("h", F.xxhash64("text")))
    common = (rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LABELS)
                  .select("lang").collect())                 # at most LABELS rows
    langs = [r.lang for r in common]
    rows = rows.where(F.col("lang").isin(langs))
    bucket = F.pmod(F.col("h"), F.lit(min(rows_per_lang, TRAIN_ROWS // max(len(langs), 1))))
    chosen = rows.groupBy("lang", bucket.alias("b")).agg(F.min("h").alias("h")).select("lang", "h")

    @F.pandas_udf(BinaryType())
    def vectors(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield batch.map(lambda t: features(t).astype("<f2").tobytes()).astype(object)

    # chosen has at most TRAIN_ROWS rows whatever the labels, a proven bound for the broadcast
    sample = (rows.join(F.broadcast(chosen), ["lang", "h"]).select("lang", "h", vectors("text").alias("v"))
                  .groupBy("lang", "h").agg(F.min("v").alias("v")).collect())
    sample.sort(key=lambda r: (r.lang, r.h))
    return LanguageModel(with_offset([r.v for r in sample]), [r.lang for r in sample])


def identify(df: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1) to every row."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)   # weights: languages x DIMENSIONS, not data

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def predicted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = shared.value.predict
        for batch in texts:
            yield pd.DataFrame([predict(t) for t in batch], columns=["lang_pred", "score"])

    return (df.withColumn("__lang", predicted(text_or_empty(text_col)))
              .withColumn("lang_pred", F.col("__lang.lang_pred")).withColumn("score", F.col("__lang.score"))
              .drop("__lang"))


def predicted_languages(documents: DataFrame) -> DataFrame:
    """Per document the fold, the predicted language and its score."""
    model = train(documents)
    return (identify(documents.select("doc_id", "text", held_out().alias("held_out")), model)
            .select("doc_id", "held_out", "lang_pred", "score"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """Pipeline stage: documents with an identified language, columns unchanged whatever their names."""
    return (identify(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), F.col("text")),
                     train(docs))
            .where(F.col("lang_pred") != "und").select("__doc.*"))
