"""Byte-level BPE encoding and decoding.

Encoding never simulates merges over the text. The trie of an Aho-Corasick
automaton over the vocabulary (bytes mapped to Latin-1 characters) gives the
longest token at a byte of a piece; the encoder walks left to right taking
longest matches and backs up whenever a token cannot stand next to its left neighbour in any
byte-pair merge result. That adjacency test undoes merges from the boundary
outwards and is memoised, and every byte position is ruled out at most once,
so the work per piece is linear and the ids equal those of the merge loop.

Edge cases: null text is the empty text; empty text has no ids and decodes to
no bytes; repeated rows are encoded alike; an empty table gives an empty
result; other columns are passed through, an input column of an output's name
is replaced.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from retail_lake.llm.common import Remembered, ship_package, spaced_runs, text_or_empty

PIECE_CACHE = 30_000       # entries of a generation per worker; they bound memory, not results
RUN_CACHE = 250_000        # about 50 MB a generation
PAIR_CACHE = 250_000
ENDINGS = ".,;:!?"         # signs that the pattern matches together after a word


def load_ranks(path: str) -> dict[bytes, int]:
    """token -> rank from a tiktoken rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


class BytePairEncoder:
    """Exact byte-pair encoding of pieces by longest matches and backtracking."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        import public_tokenizers

        self.findall = regex.compile(pattern).findall
        self.cuts = pattern == public_tokenizers.PATTERN     # cuts at single spaces hold for this pattern
        self.by_text = {t.decode("latin-1"): r for t, r in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for t, r in self.by_text.items():
            self.automaton.add_word(t, r)
        self.width = {r: len(t) for t, r in ranks.items()}
        self.widest = max(self.width.values())
        #: every path of the trie -> its longest prefix that is a token
        self.starting: dict[str, int] = {}
        for t in sorted(self.by_text, key=len):
            longest = -1
            for n in range(1, len(t) + 1):
                longest = self.by_text.get(t[:n], longest)
                self.starting[t[:n]] = longest
        self.packed = {r: r.to_bytes(4, "little") for r in self.token}
        self.shorter = {r: self._longest_proper_prefix(t) for t, r in ranks.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self._fits: dict[int, bool] = {}
        self._find_last_merges()
        self._fits.clear()
        self.pieces = Remembered(self.encode_piece, PIECE_CACHE)
        self.runs = Remembered(self._encode_spaced_run, RUN_CACHE)
        self.sizes = np.zeros(max(self.token) + 1, dtype=np.int64)
        self.starts = np.zeros(max(self.token) + 1, dtype=np.int64)
        self.flat = np.frombuffer(b"".join(self.token.values()), dtype=np.uint8)
        self.sizes[list(self.token)] = [len(t) for t in self.token.values()]
        self.starts[list(self.token)] = np.cumsum(self.sizes[list(self.token)]) - self.sizes[list(self.token)]

    def _longest_proper_prefix(self, t: bytes) -> int | None:
        for n in range(len(t) - 1, 0, -1):
            if (r := self.ranks.get(t[:n])) is not None:
                return r
        return None

    def _find_last_merges(self) -> None:
        """For every token the pair that merging joins last; single bytes have none."""
        for rank in sorted(self.token):
            t, head = self.token[rank], self.shorter[rank]
            while head is not None:
                tail = self.ranks.get(t[len(self.token[head]):])
                if tail is not None and head < rank and tail < rank and self.fits(head, tail):
                    self.parts[rank] = (head, tail)
                    self.joined[head, tail] = rank
                    break
                head = self.shorter[head]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging can leave ``left`` and ``right`` side by side (memoised)."""
        known = self._fits.get(left << 32 | right)
        if known is None:
            if len(self._fits) >= PAIR_CACHE:
                self._fits.clear()
            known = self._fits[left << 32 | right] = self._adjacent(left, right)
        return known

    def _adjacent(self, left: int, right: int) -> bool:
        before = None          # a join across the boundary below this rank would have come first
        while True:
            across = self.joined.get((left, right))
            if across is not None and (before is None or across < before):
                return False
            open_left, open_right = self.parts.get(left), self.parts.get(right)
            if open_left is None and open_right is None:
                return True
            if open_left is not None and (open_right is None or left > right):
                before, left = left, open_left[1]            # equal ranks: the left join is first
            else:
                before, right = right + 1, open_right[0]

    def encode_piece(self, piece: str) -> bytes:
        """Packed ids of one pattern match."""
        raw = piece.encode("utf-8", "replace").decode("latin-1")
        whole = self.by_text.get(raw)
        if whole is not None:
            return self.packed[whole]
        n, width, fits, shorter = len(raw), self.width, self._fits, self.shorter
        dead: set[int] = set()                               # ends after which no token sequence goes on
        ids: list[int] = []
        reach, starting, widest = self.automaton.longest_prefix, self.starting, self.widest
        at, last, candidate = 0, -1, starting[raw[:reach(raw[:widest])]]
        while at < n:
            while candidate is not None:
                end = at + width[candidate]
                if end not in dead:
                    if last < 0:
                        break
                    fit = fits.get(last << 32 | candidate)
                    if fit is None:
                        fit = self.fits(last, candidate)
                    if fit:
                        break
                candidate = shorter[candidate]
            if candidate is None:                            # nothing can follow here: back up one token
                dead.add(at)
                candidate = ids.pop()
                at -= width[candidate]
                candidate = shorter[candidate]
                last = ids[-1] if ids else -1
            else:
                ids.append(candidate)
                last, at = candidate, end
                if at < n:
                    window = raw[at:at + widest]
                    candidate = starting[window[:reach(window)]]
        packed = self.packed
        return b"".join([packed[i] for i in ids])

    def _encode_run(self, run: str) -> bytes:
        return b"".join([self.pieces[p] for p in self.findall(run)])

    def _encode_spaced_run(self, run: str) -> bytes:
        if run.isalpha():                                    # a space and letters: one match of the pattern
            return self.encode_piece(" " + run)
        word = run.rstrip(ENDINGS)
        if word.isalpha():                                   # letters, then one match of other signs
            return self.runs[word] + self.pieces[run[len(word):]]
        return self._encode_run(" " + run)

    def encode(self, text: str) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit integers."""
        first, *rest = spaced_runs(text) if self.cuts else (text,)
        return self._encode_run(first) + b"".join(map(self.runs.__getitem__, rest))

    def decode(self, ids: bytes) -> bytes:
        """Bytes of packed ids, gathered from the concatenated vocabulary."""
        ids = np.frombuffer(ids, dtype="<u4")
        if not len(ids):
            return b""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        source = np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(ends[-1])
        return self.flat[source].tobytes()


_ENCODERS: dict[object, BytePairEncoder] = {}


def _encoder(vocabulary, digest: str, pattern: str) -> BytePairEncoder:
    """One encoder per Python worker and vocabulary; ``digest`` is of the vocabulary's content."""
    key = (digest, pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = BytePairEncoder(vocabulary.value, pattern)
    return _ENCODERS[key]


class Tokenizer:
    """Byte-pair tokenizer of a session; the rank file (about 1 MB, fixed) is broadcast once."""

    def __init__(self, spark: SparkSession, path: str | None = None, pattern: str | None = None):
        import public_tokenizers

        ship_package(spark)
        self.pattern = pattern or public_tokenizers.PATTERN
        path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
        ranks = load_ranks(path)
        self.digest = hashlib.sha256(b"".join(b"%d %d " % (r, len(t)) + t for t, r in ranks.items())).hexdigest()
        self.vocabulary = spark.sparkContext.broadcast(ranks)

    def encode(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        """Add ``token_ids`` (packed little-endian uint32) and ``n_tokens``."""
        vocabulary, digest, pattern = self.vocabulary, self.digest, self.pattern

        @F.pandas_udf(BinaryType())
        def ids_of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encoder = _encoder(vocabulary, digest, pattern)
            for batch in texts:
                yield batch.map(encoder.encode).astype(object)

        return (df.withColumn("token_ids", ids_of(text_or_empty(text_col)))
                  .withColumn("n_tokens", F.expr("cast(octet_length(token_ids) div 4 as bigint)")))

    def decode(self, df: DataFrame, ids_col: str = "token_ids") -> DataFrame:
        """Add ``decoded`` (bytes) from packed ids; null ids are no ids."""
        vocabulary, digest, pattern = self.vocabulary, self.digest, self.pattern

        @F.pandas_udf(BinaryType())
        def bytes_of(packed: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encoder = _encoder(vocabulary, digest, pattern)
            for batch in packed:
                yield batch.map(encoder.decode).astype(object)

        return df.withColumn("decoded", bytes_of(F.coalesce(F.col(ids_col), F.lit(bytearray()))))

    def round_trip(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        """Add ``token_ids``, ``n_tokens`` and ``decoded`` in one pass: ids as encode(), bytes as decode() of them."""
        vocabulary, digest, pattern = self.vocabulary, self.digest, self.pattern

        @F.pandas_udf("struct<token_ids:binary,decoded:binary>")
        def both(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            encoder = _encoder(vocabulary, digest, pattern)
            for batch in texts:
                ids = [encoder.encode(t) for t in batch]
                yield pd.DataFrame({"token_ids": ids, "decoded": [encoder.decode(i) for i in ids]}, dtype=object)

        return (df.withColumn("__both", both(text_or_empty(text_col)))
                  .withColumn("token_ids", F.col("__both.token_ids")).withColumn("decoded", F.col("__both.decoded"))
                  .withColumn("n_tokens", F.expr("cast(octet_length(token_ids) div 4 as bigint)")).drop("__both"))


def encoded_digests(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Per document the id count and the digests of ids and decoded bytes."""
    tokenizer = Tokenizer(spark)
    coded = tokenizer.round_trip(documents.select("doc_id", "text"))
    return coded.select(F.col("doc_id"), "n_tokens",
                        F.sha2(F.col("token_ids"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
