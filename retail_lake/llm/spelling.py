"""Spelling variants: words one edit apart, grouped under their most frequent form.

Words of the whole texts are counted, then joined with themselves by pivotal
grams. All bigrams of the words are ordered from rare to frequent. A word's
gram prefix is its three rarest positional bigrams (2 * 1 edit + 1) with
whatever ties the last of them; of those, two bigrams that share no character are its
pivots, chosen by dynamic programming for the least sum of frequencies. One
edit touches at most one pivot, and of two words an edit apart the one whose
prefix ends earlier has its untouched pivot in the other's prefix. So pivots are looked
up in the index of the other words' prefixes only.

Position limits: before the first character of the second pivot an edit leaves the
second pivot and all that follows in place, counted from the end; at or after it the edit leaves the
first pivot and all that stands before, counted from the start. Hence the
first pivot is looked up with the characters before it at its own
position, the second with the characters after it at its position shifted by
the difference in length, for lengths that differ by at most one. Where that part
is short (under CERTAIN characters, so that many words share it) the lookup is
split by the word's other end: either the edit spares its last (first) END characters,
which are looked up too, or it falls on them and spares all the rest. What meets is compared by
letter parities and verified by the edit distance. All lookups are equi-joins on a hash, which
Spark shuffles and splits; nothing is capped.

Edge cases: null text has no words, a null id is the empty string in the hash
that decides deletions; repeated rows count again; ties between forms go to the
smallest in code-point order; words without near words are their own root;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.llm.common import ship_package
from retail_lake.operators.stages import stage

Q, EDITS = 2, 1
LEAST_LENGTH, LEAST_COUNT = 7, 2
CERTAIN, END = 5, 3        # shorter parts are looked up with the other end; CERTAIN - 1 + END <= LEAST_LENGTH
FORM_FACTOR = 10           # a form is so many times as frequent
DELETE_EVERY = 31          # of the hashes of (document, run), so many lose a character

LETTERS = "a-z\\\\u00C0-\\\\u00FF"       # after A-Z are lower-cased


def word_counts(documents: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of all documents, characters deleted by the hash rule.

    Runs shorter than the least length cannot give a word and are not split off.
    """
    lowered = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), lowered.alias("t")).selectExpr(
        "id", f"explode(regexp_extract_all(t, '[{LETTERS}]{{{least_length},}}', 0)) as run")
    hashed = runs.selectExpr("run", "crc32(cast(concat(id, ':', run) as binary)) as h")
    at = "cast(h % length(run) as int)"
    words = hashed.selectExpr(f"if(h % {DELETE_EVERY} = 0, concat(left(run, {at}), substr(run, {at} + 2)), run) as word")
    return (words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= least_count))


def gram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """bigram -> (place from rare to frequent, frequency). At most the alphabet squared: 90 letters, 8,100 bigrams."""
    grams = words.selectExpr(f"explode(transform(sequence(1, length(word) - {Q - 1}), i -> substr(word, i, {Q}))) as g")
    counted = sorted((r["count"], r.g) for r in grams.groupBy("g").count().collect())
    return {g: (i, n) for i, (n, g) in enumerate(counted)}


def gram_prefix(word: str, order: dict[str, tuple[int, int]]) -> list[int]:
    """Positions of the word's Q * EDITS + 1 rarest bigrams and of all that tie with the last, in order of position."""
    place = [order[word[i:i + Q]][0] for i in range(len(word) - Q + 1)]
    last = sorted(place)[Q * EDITS]
    return [i for i, p in enumerate(place) if p <= last]


def choose_pivots(word: str, prefix: list[int], order: dict[str, tuple[int, int]]) -> list[int]:
    """Positions of EDITS + 1 prefix bigrams that share no character, with the least sum of frequencies.

    best[k] after the i-th bigram: the least sum of k bigrams among the first i, with
    their positions; a bigram goes with the best of those that end before it.
    """
    want = EDITS + 1
    rows: list[list[tuple[int, tuple[int, ...]] | None]] = []
    ends: list[int] = []
    for i, p in enumerate(prefix):
        cost = order[word[p:p + Q]][1]
        free = i                                              # bigrams before this one that it does not touch
        while free and ends[free - 1] > p:
            free -= 1
        before = rows[free - 1] if free else [(0, ())] + [None] * want
        skip = rows[-1] if rows else [(0, ())] + [None] * want
        row = [(0, ())]
        for k in range(1, want + 1):
            taken = None if before[k - 1] is None else (before[k - 1][0] + cost, before[k - 1][1] + (p,))
            row.append(min((x for x in (taken, skip[k]) if x is not None), default=None))
        rows.append(row)
        ends.append(p + Q)
    return list(rows[-1][want][1])


def _key(kind: str, length: int, *parts) -> int:
    return xxhash.xxh64_intdigest(f"{kind}{length}:{':'.join(map(str, parts))}") - (1 << 63)


LENGTHS = range(-EDITS, EDITS + 1)                            # by how much the other word may be longer


def lookup_keys(w: str, first: int, second: int) -> list[int]:
    """Keys under which a word with these pivots looks for words one edit away."""
    n, left, right = len(w), w[:first + Q], w[second:]
    keys = []
    for d in LENGTHS:
        if len(left) >= CERTAIN:
            keys.append(_key("l", n + d, left))
        else:
            keys += [_key("l", n + d, left, w[-END:]), _key("start", n + d, first, w[:n - END])]
        if len(right) >= CERTAIN:
            keys.append(_key("r", n + d, right))
        else:
            keys += [_key("r", n + d, right, w[:END]), _key("rest", n + d, len(right), w[END:])]
    return keys


def index_keys(x: str, prefix: list[int]) -> list[int]:
    """Keys under which a word is found, for each bigram of its prefix."""
    n, keys = len(x), []
    for p in prefix:
        left, right = x[:p + Q], x[p:]
        if len(left) >= CERTAIN:
            keys.append(_key("l", n, left))
        else:
            keys += [_key("l", n, left, x[-END:]), *(_key("start", n, p, x[:n - d - END]) for d in LENGTHS)]
        if len(right) >= CERTAIN:
            keys.append(_key("r", n, right))
        else:
            keys += [_key("r", n, right, x[:END]), *(_key("rest", n, len(right), x[END + d:]) for d in LENGTHS)]
    return keys


def letter_parities(word: str) -> int:
    """64 bits, each the parity of how often letters of one class occur. A replaced letter flips two at most."""
    bits = 0
    for c in word:
        bits ^= 1 << (ord(c) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def _entries(words: DataFrame, order: dict[str, tuple[int, int]], pivots: bool) -> DataFrame:
    """Index entries of the prefix grams, or lookups of the pivots: word, key, last place of the prefix, parities."""
    shared = words.sparkSession.sparkContext.broadcast(order)

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        order = shared.value
        for batch in batches:
            rows = []
            for w in batch["word"]:
                prefix = gram_prefix(w, order)
                last, bits = max(order[w[p:p + Q]][0] for p in prefix), letter_parities(w)
                keys = lookup_keys(w, *choose_pivots(w, prefix, order)) if pivots else index_keys(w, prefix)
                rows.extend((w, k, last, bits) for k in keys)
            yield pd.DataFrame(rows, columns=["word", "k", "last", "bits"])

    return words.select("word").mapInPandas(made, "word string, k bigint, last int, bits bigint")


def near_words(words: DataFrame) -> DataFrame:
    """All pairs (a, b), a before b in code-point order, one edit apart; ``words`` has distinct words of at least
    LEAST_LENGTH code points."""
    ship_package(words.sparkSession)
    order = gram_order(words)
    probes = _entries(words, order, pivots=True).selectExpr("word as w", "k", "last as w_last", "bits as w_bits")
    index = _entries(words, order, pivots=False).selectExpr("word as x", "k as x_k", "last as x_last", "bits as x_bits")
    # parities first: the distance is worked out for what passes
    met = probes.join(index, F.expr(f"k = x_k and w_last <= x_last and bit_count(w_bits ^ x_bits) <= {2 * EDITS} and w != x"))
    return (met.where(f"levenshtein(w, x, {EDITS}) = {EDITS}")
            .selectExpr("least(w, x) as a", "greatest(w, x) as b").distinct())


def spelling_forms(words: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """Per (word, n): form, root, n_near and form_n by the near words' counts."""
    words = stage(words, "words")
    pairs = stage(near_words(words), "near_words")
    both = pairs.selectExpr("a as word", "b as other").unionByName(pairs.selectExpr("b as word", "a as other"))
    counted = both.join(words.selectExpr("word as other", "n as other_n"), "other")
    near = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                       F.expr("min(struct(-other_n as least, other as form))").alias("best"))
    formed = stage(words.join(near, "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0L) as n_near", f"if(-best.least >= {factor} * n, best.form, null) as form",
        f"if(-best.least >= {factor} * n, -best.least, null) as form_n"), "forms")
    roots = _roots(formed.where("form is not null").select("word", "form"))
    return formed.join(roots, "word", "left").selectExpr(
        "word", "form", "coalesce(root, word) as root", "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of words that have a form. A form is ``factor`` times as frequent, so chains are short:
    every round doubles how far a word has been followed, until none moves."""
    step = stage(links.selectExpr("word", "form as root"), "roots")
    while True:
        onward = step.selectExpr("word as root", "root as next")
        followed = stage(step.join(onward, "root", "left").selectExpr(
            "word", "coalesce(next, root) as root", "next is not null as moved"), "roots")
        if followed.where("moved").limit(1).count() == 0:
            return step
        step = followed.select("word", "root")


def spelling_variants(documents: DataFrame) -> DataFrame:
    """Words of the documents with their forms, roots and counts."""
    return spelling_forms(word_counts(documents))
