"""Token counts by a linear longest-match automaton.

Greedy word-piece splitting takes the longest vocabulary entry at every
position. The automaton is the vocabulary trie; every node carries a failure
link (the node of what is left after greedy splitting has popped tokens off
the node's string) and the precomputed number of tokens popped on the way.
One left-to-right pass over a word then adds up popped counts: the length of
the splitting without building a piece.

Edge cases: null and empty text have no words and no pieces; the vocabulary
holds every byte, so each word can be split; ties cannot occur (the longest
match is unique); empty tables give an empty result; of extra columns only the
id is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lake.llm.bpe import load_ranks
from retail_lake.llm.common import Remembered, ship_package, spaced_runs, text_or_empty

RUN_CACHE = 150_000        # entries of a generation per worker; bounds memory, not results


class LongestMatchCounter:
    """Greedy word-piece lengths over a byte vocabulary that holds all single bytes."""

    def __init__(self, vocabulary: list[bytes], pattern: str):
        import regex

        import public_tokenizers

        self.findall = regex.compile(pattern).findall
        self.cuts = pattern == public_tokenizers.PATTERN     # cuts at single spaces hold for this pattern
        self.step: list[dict[int, int]] = [{}]
        is_token = [False]
        for token in vocabulary:
            node = 0
            for byte in token:
                nxt = self.step[node].get(byte)
                if nxt is None:
                    nxt = self.step[node][byte] = len(self.step)
                    self.step.append({})
                    is_token.append(False)
                node = nxt
            is_token[node] = True
        if any(b not in self.step[0] or not is_token[self.step[0][b]] for b in range(256)):
            raise ValueError("the vocabulary must hold every single byte")
        self.fail = [0] * len(self.step)
        self.popped = [0] * len(self.step)
        level = [0]
        while level:                                         # breadth first: links point to shorter strings
            deeper = []
            for node in level:
                for byte, child in self.step[node].items():
                    deeper.append(child)
                    if is_token[child]:
                        self.fail[child], self.popped[child] = 0, 1
                        continue
                    rest, count = self.fail[node], self.popped[node]
                    while byte not in self.step[rest]:
                        count += self.popped[rest]
                        rest = self.fail[rest]
                    self.fail[child], self.popped[child] = self.step[rest][byte], count
            level = deeper
        self.runs = Remembered(self._count_spaced_run, RUN_CACHE)

    def length(self, word: bytes) -> int:
        step, fail, popped = self.step, self.fail, self.popped
        node = count = 0
        for byte in word:
            while byte not in step[node]:
                count += popped[node]
                node = fail[node]
            node = step[node][byte]
        while node:
            count += popped[node]
            node = fail[node]
        return count

    def _count_run(self, run: str) -> tuple[int, int]:
        words = self.findall(run)
        return len(words), sum([self.length(w.encode("utf-8", "replace")) for w in words])

    def _count_spaced_run(self, run: str) -> tuple[int, int]:
        if run.isalpha():                                    # a space and letters: one match of the pattern
            return 1, self.length(f" {run}".encode())
        return self._count_run(" " + run)

    def count(self, text: str) -> tuple[int, int]:
        """(words, pieces) of the whole text."""
        first, *rest = spaced_runs(text) if self.cuts else (text,)
        counts = [self._count_run(first), *map(self.runs.__getitem__, rest)]
        return tuple(map(sum, zip(*counts)))


_COUNTERS: dict[object, LongestMatchCounter] = {}


def count_tokens(spark: SparkSession, df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Per row: id, ``n_words`` and ``n_pieces`` (greedy longest-match pieces of all words)."""
    import public_tokenizers

    ship_package(spark)
    pattern = pattern or public_tokenizers.PATTERN
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    vocabulary = spark.sparkContext.broadcast(sorted(load_ranks(path)))    # a fixed vocabulary file

    @F.pandas_udf("struct<n_words:bigint,n_pieces:bigint>")
    def lengths(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        key = (vocabulary.id if hasattr(vocabulary, "id") else id(vocabulary), pattern)
        if key not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[key] = LongestMatchCounter(vocabulary.value, pattern)
        count = _COUNTERS[key].count
        for batch in texts:
            yield pd.DataFrame([count(t) for t in batch], columns=["n_words", "n_pieces"], dtype="int64")

    return (df.select(F.col(f"`{id_col}`"), lengths(text_or_empty(text_col)).alias("__n"))
              .select(F.col(f"`{id_col}`"), "__n.n_words", "__n.n_pieces"))
