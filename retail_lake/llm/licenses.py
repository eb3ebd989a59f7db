"""License scan by a positional rare-token index.

The license phrases are templates; the index holds, for every template word,
the templates and positions where it stands. Word rarity is the inverse
document frequency over all documents (counted once, map-side combined; the
template words are a fixed small set). In each file the license words that
occur are looked up from the highest IDF down; a phrase is placed by its
rarest word, a longer passage by any of its rarest positions, one more than may
differ, and every occurrence
of such a word proposes one alignment of the whole template by relative
position. A phrase template must then stand word
for word at the alignment. A text template collects the votes of its other
words at the same relative position, allows gaps, and only counts if its
mandatory key phrase stands consecutively inside the aligned span.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.
Completeness: a place of a phrase holds every word of it, so it holds the
phrase's rarest word, which is always looked up. Of a passage's n words at
most n - ceil(0.8 n) may differ, so a file that holds it agrees at one of any
n - ceil(0.8 n) + 1 of its positions.

Edge cases: null and empty text have no words, no places, empty labels and
score 0; overlapping places are all counted; ties in IDF go to the
alphabetically first word; repeated rows are scanned alike; empty tables give
an empty result; of extra columns only the id is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.llm.common import ship_package, text_or_empty, words

#: Base phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Well-known passages, label, mandatory key phrase.
PASSAGES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit",
     "permission is hereby granted"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance",
     "apache-2", "apache license"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license", "gpl", "gnu general public license"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3", "gnu general public license"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd",
     "redistribution and use in source and binary forms"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-2",
     "mozilla public license"),
    ("this work is licensed under a creative commons attribution noncommercial license", "cc-by-nc",
     "creative commons attribution noncommercial"),
    ("this work is licensed under a creative commons attribution license", "cc-by", "creative commons attribution"),
]
MIN_SHARE = 0.8            # of a passage's words at their relative positions


class PositionalIndex:
    """Templates, the positions of their words, and the word IDFs."""

    def __init__(self, idf: dict[bytes, float], min_share: float = MIN_SHARE):
        self.idf, self.min_share = idf, min_share
        self.templates = [(words(p), label, None) for p, label in PHRASES.items()]
        self.templates += [(words(p), label, words(key)) for p, label, key in PASSAGES]
        rarity = lambda w: (-idf.get(w, math.inf), w)
        #: license word -> [(template, position)]: a phrase by its rarest word, a passage by its rarest positions
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for k, (template, _, key) in enumerate(self.templates):
            n = len(template)
            anchors = 1 if key is None else n - math.ceil(min_share * n) + 1
            for i in sorted(range(n), key=lambda i: (rarity(template[i]), i))[:anchors]:
                self.postings.setdefault(template[i], []).append((k, i))
        self.by_rarity = sorted(self.postings, key=rarity)

    def scan(self, text: str) -> tuple[int, list[tuple[bool, str, int, int, float]]]:
        """Number of words, and (phrase?, label, first word, word after the last, share of the template) of each span."""
        w = words(text)
        present = set(w).intersection(self.postings)
        spans = []
        seen: set[tuple[int, int]] = set()                   # alignments of passages already judged
        for anchor in [a for a in self.by_rarity if a in present]:
            starts = [i for i, x in enumerate(w) if x == anchor]
            for k, offset in self.postings[anchor]:
                template, label, key = self.templates[k]
                n = len(template)
                for i in starts:
                    at = i - offset
                    if key is None:
                        if at >= 0 and w[at:at + n] == template:
                            spans.append((True, label, at, at + n, 1.0))
                        continue
                    if (k, at) in seen:
                        continue
                    seen.add((k, at))
                    hits = sum(1 for j, x in enumerate(template) if 0 <= at + j < len(w) and w[at + j] == x)
                    first, end = max(0, at), min(len(w), at + n)
                    if hits >= self.min_share * n and _holds(w[first:end], key):
                        spans.append((False, label, first, end, hits / n))
        return len(w), sorted(spans, key=lambda s: s[2:4] + s[:2])


def _holds(span: list[bytes], phrase: list[bytes]) -> bool:
    return any(span[i:i + len(phrase)] == phrase for i in range(len(span) - len(phrase) + 1))


def word_idf(df: DataFrame, text_col: str = "text") -> dict[bytes, float]:
    """IDF over all documents of every template word (a fixed set of about a hundred)."""
    vocabulary = sorted({w for p in [*PHRASES, *(p for p, _, _ in PASSAGES)] for w in words(p)})

    @F.pandas_udf("array<int>")
    def present(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        place = {w: i for i, w in enumerate(vocabulary)}
        for batch in texts:
            yield pd.Series([sorted(place[w] for w in set(words(t)).intersection(place)) for t in batch],
                            dtype=object)

    # not deterministic only in name: keeps the optimizer from running it again in a filter of its own
    rows = df.select(present.asNondeterministic()(text_or_empty(text_col)).alias("ws"))
    n, counts = 0, {}
    for r in (rows.select(F.explode(F.concat(F.array(F.lit(-1)), "ws")).alias("w")).groupBy("w").count().collect()):
        if r.w < 0:
            n = r["count"]
        else:
            counts[vocabulary[r.w]] = r["count"]
    return {w: math.log((1 + n) / (1 + counts.get(w, 0))) for w in vocabulary}


SPAN = ("is_phrase", "label", "first_word", "end_word", "share")


def license_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, and the spans of all places of phrases and passages, in words from 0, in order."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(word_idf(df, text_col))

    @F.pandas_udf("struct<n_words:bigint,spans:array<struct<is_phrase:boolean,label:string,first_word:bigint,"
                  "end_word:bigint,share:double>>>")
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = PositionalIndex(shared.value)
        for batch in texts:
            scanned = [index.scan(t) for t in batch]
            yield pd.DataFrame({"n_words": pd.Series([n for n, _ in scanned], dtype="int64"),
                                "spans": pd.Series([[dict(zip(SPAN, s, strict=True)) for s in spans]
                                                    for _, spans in scanned], dtype=object)})

    # not deterministic only in name: the scan runs once, however many columns are made of it
    return (df.select(F.col(id_col), found.asNondeterministic()(text_or_empty(text_col)).alias("__l"))
              .select(F.col(id_col), F.col("__l.n_words").alias("n_words"), F.col("__l.spans").alias("spans")))


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of the spans: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    base = "filter(spans, s -> s.is_phrase)"
    labels = "array_join(sort_array(array_distinct(transform({0}, s -> s.label))), ',')"
    return license_spans(df, id_col, text_col).select(
        F.col(id_col), "n_words", F.expr(f"cast(size({base}) as bigint)").alias("n_base"),
        F.expr(f"array_min(transform({base}, s -> s.first_word))").alias("first_word"),
        F.expr(f"array_max(transform({base}, s -> s.first_word))").alias("last_word"),
        F.expr(labels.format(base)).alias("base_labels"), F.expr(labels.format("spans")).alias("labels"),
        F.expr("coalesce(array_max(transform(spans, s -> s.share)), 0D)").alias("score"))
