"""Toxicity by a weighted finite-state grammar over clauses.

A text is read clause by clause (ended by ``. ! ? ; |`` or a line break). A
cascade of sequential transducers over a small alphabet rewrites the clause:

1. lexicon: every word becomes one symbol: strong or weak insult, threat,
   target (a person spoken to or of), negation, reporting verb, other;
2. negation: an insult or threat within three words after a negation becomes a negated one;
3. reported speech: after a reporting verb, or between quotation marks, it becomes a reported one;
4. clause: remembers whether a target was met and the gravest match, and at the
   end of the clause writes the clause's kind (strong or weak insult, each alone, repeated or at a
   target; threat, alone or at a target; negated; reported).

The four are composed once into a single machine by the product of
their states. Every clause kind has a weight; a text's score is the logistic of
the weights of its matched clauses, of their first ones and of the further ones
(three at most count), so an isolated word never scores outside of its clause.

Learnt from labels, on at most SAMPLE_ROWS distinct texts of each label
outside the held-out fold, near copies (equal smallest hash of their five-word
shingles) once: further insults, as word beginnings that toxic texts hold far more often than others
(a beginning stands for all its inflections), and the weights, by a logistic regression
drawn towards the grammar's prior weights, so that kinds the labels never show keep those.
Sampled rows are weighted back to the numbers of their labels. Everything else reads every whole text.

Edge cases: null and empty texts have no clauses and get the score of a text without
matches; without labelled rows the prior weights hold; rows without a label are not learnt from, of
several label rows of an id any 1 counts; a null id counts as the empty text when folds are dealt; repeated
rows are scored alike; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_lake.llm.common import Remembered, ship_package, text_or_empty
from retail_lake.operators.stages import stage

#: The words that the grammar knows before it sees a label.
INSULTS = ("idiot idiots idiotic moron morons moronic stupid stupidity dumb fool fools foolish loser losers scum trash "
           "clown clowns pathetic worthless disgusting imbecile imbeciles cretin jerk jerks bastard bastards creep "
           "garbage filth filthy vermin parasite parasites coward cowards degenerate degenerates freak freaks pig pigs "
           "retard retarded bitch whore slut asshole assholes dickhead").split()
THREATS = ("kill killed murder hurt beat smash stab shoot strangle burn destroy hang drown punch crush slap "
           "deserve suffer").split()
TARGETS = ("you your youre yours u ur yourself he his him she her they them their these those people everyone "
           "anyone somebody").split()
NEGATIONS = "not no never none nobody neither nor isnt arent wasnt werent dont doesnt didnt wont cant without".split()
REPORTS = ("said says say saying told tells wrote writes written called calls quoted quotes quote reported reports "
           "according claimed claims stated states shouted yelled replied").split()

OTHER, STRONG, WEAK, THREAT, TARGET, NEGATION, REPORT, QUOTE, END = "oswhtnrq#"
NEGATED, REPORTED = "x", "z"
MATCHES = STRONG + WEAK + THREAT
#: Clause kinds with their prior weights, gravest first.
KINDS = {"menace": 3.0, "strong_targeted": 4.0, "strong_repeated": 4.0, "strong": 3.0, "weak_repeated": 1.5,
         "weak": 0.5, "threat": 0.3, "negated": 0.3, "reported": 0.3}
PRIOR_BIAS, PRIOR_SPREAD = -3.0, 2.0
MOST = 3                   # clauses of a kind that count

SAMPLE_ROWS = 8000         # distinct texts of each label that are learnt from, at most
SHORTEST, LONGEST = 3, 8   # characters of a learnt beginning
LEAST_TEXTS, LEAST_Z, LEAST_RATIO, STRONG_RATIO = 6, 6.0, 8.0, 40.0
KEPT_BY_LONGER = 0.8       # a beginning goes if a longer one holds so much of its texts

_SEPARATE = bytes(b if chr(b).isalnum() or b >= 0x80 else 0x22 if b == 0x22 else 0x2E if b in b".!?;|\n" else 0x20
                  for b in range(128)) + bytes(range(128, 256))


def tokens(text: str) -> list[bytes]:
    """Lower-cased words, quotation marks and clause ends (``.``) of the whole text; apostrophes join."""
    raw = text.lower().encode("utf-8", "replace").translate(_SEPARATE, b"'")
    return raw.replace(b".", b" . ").replace(b'"', b' " ').split()


class Machine:
    """A sequential transducer: (state, symbol) -> (state, output); outputs of several symbols are strings."""

    def __init__(self, start, step, symbols: str):
        self.start, self.symbols, self.arcs = start, symbols, {}
        todo = [start]
        while todo:                                           # only the states that can be reached
            state = todo.pop()
            for a in symbols:
                if (state, a) not in self.arcs:
                    self.arcs[state, a] = step(state, a)
                    todo.append(self.arcs[state, a][0])

    def then(self, other: Machine) -> Machine:
        """The composition: ``other`` reads what this machine writes."""
        def step(state, a):
            mine, out = self.arcs[state[0], a]
            theirs, written = state[1], []
            for b in out:
                theirs, w = other.arcs[theirs, b]
                written.extend(w)
            return (mine, theirs), tuple(written)
        return Machine((self.start, other.start), step, self.symbols)


def negation_machine(window: int = 3) -> Machine:
    def step(left, a):
        if a == END:
            return 0, a
        if a == NEGATION:
            return window, a
        return max(0, left - 1), NEGATED if left and a in MATCHES else a
    return Machine(0, step, OTHER + MATCHES + TARGET + NEGATION + REPORT + QUOTE + END)


def reported_machine() -> Machine:
    def step(state, a):
        told, quoted = state
        if a == END:
            return (False, False), a
        if a == QUOTE:
            return (told, not quoted), a
        if a == REPORT:
            return (True, quoted), a
        return state, REPORTED if (told or quoted) and a in MATCHES + NEGATED else a
    return Machine((False, False), step, OTHER + MATCHES + TARGET + NEGATION + REPORT + QUOTE + END + NEGATED)


def clause_machine() -> Machine:
    """States: target met?, strong, weak (2 at most), threat, negated and reported matches so far."""
    def step(state, a):
        target, strong, weak, threat, negated, reported = state
        if a == END:
            kind = ("menace" if threat and target else "strong_targeted" if strong and target else
                    "strong_repeated" if strong > 1 else "strong" if strong else
                    "weak_repeated" if weak > 1 or weak and target else "weak" if weak else "threat" if threat else
                    "negated" if negated else "reported" if reported else None)
            return (False, 0, 0, False, False, False), (kind,) if kind else ()
        return (target or a == TARGET, min(2, strong + (a == STRONG)), min(2, weak + (a == WEAK)), threat or a == THREAT,
                negated or a == NEGATED, reported or a == REPORTED), ()
    return Machine((False, 0, 0, False, False, False), step,
                   OTHER + MATCHES + TARGET + NEGATION + REPORT + QUOTE + END + NEGATED + REPORTED)


class Grammar:
    """Lexicon and composed machine; learnt word beginnings are strong or weak insults."""

    def __init__(self, beginnings: dict[str, str] | None = None):
        self.symbol_of = {w: s for s, ws in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS),
                                             (THREAT, THREATS), (STRONG, INSULTS)) for w in ws}
        self.beginnings = beginnings or {}
        machine = negation_machine().then(reported_machine()).then(clause_machine())
        number = {s: i for i, s in enumerate(dict.fromkeys([machine.start, *(s for s, _ in machine.arcs)]))}
        self.arcs: dict[str, list[tuple[int, tuple[str, ...]]]] = {
            a: [None] * len(number) for a in machine.symbols}
        for (s, a), (to, out) in machine.arcs.items():
            self.arcs[a][number[s]] = (number[to], out)
        self.symbols = Remembered(self._symbol, 200_000, longest=40)
        self.match = re.compile(f"[{MATCHES}]")

    def _symbol(self, token: bytes) -> str:
        if token in (b".", b'"'):
            return END if token == b"." else QUOTE
        word = token.decode("utf-8", "ignore")
        known = self.symbol_of.get(word)
        if known is None:
            for n in range(SHORTEST, min(LONGEST, len(word)) + 1):
                known = self.beginnings.get(word[:n])
                if known:
                    break
        return known or OTHER

    def read(self, line: str) -> Counter:
        """Kinds written for a line of symbols that ends with a clause end; clauses without a match write nothing."""
        found: Counter = Counter()
        match = self.match.search(line)
        while match:
            start, end = line.rfind(END, 0, match.start()) + 1, line.index(END, match.start()) + 1
            state = 0
            for a in line[start:end]:
                state, out = self.arcs[a][state]
                found.update(out)
            match = self.match.search(line, end)
        return found

    def kinds(self, text: str) -> Counter:
        """Number of matched clauses of each kind."""
        return self.read("".join(map(self.symbols.__getitem__, tokens(text))) + END)

    def levels(self, text: str) -> tuple[int, ...]:
        """Per kind the number of its clauses, MOST at most."""
        found = self.kinds(text)
        return tuple(min(MOST, found[k]) for k in KINDS)


def _design(levels: np.ndarray) -> np.ndarray:
    """Columns: constant; per kind any clause; per kind the further ones as a share of MOST - 1."""
    return np.hstack([np.ones((len(levels), 1)), levels > 0, np.maximum(levels - 1, 0) / (MOST - 1)]).astype(float)


def prior() -> np.ndarray:
    weights = list(KINDS.values())
    return np.array([PRIOR_BIAS, *weights, *(w / 2 for w in weights)])


def fit(levels: np.ndarray, positive: np.ndarray, negative: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights of the logistic regression on counted rows, with a Gaussian prior, by Newton steps."""
    w0 = prior()
    if not len(levels):
        return w0
    x, n = _design(levels), positive + negative
    spread = np.full(len(w0), PRIOR_SPREAD ** -2)
    spread[0] = 0.01
    w = w0.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (positive - n * p) - spread * (w - w0)
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(spread)
        move = np.linalg.solve(hessian, gradient)
        w = w + move * min(1.0, 2.0 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-9:
            break
    w[1:] = np.maximum(w[1:], 0.0)                            # a match never speaks for a text
    return w


class ToxicityModel:
    def __init__(self, beginnings: dict[str, str], weights: np.ndarray):
        self.beginnings, self.weights, self.grammar, self.known = beginnings, weights, None, {}

    def __getstate__(self):
        return self.beginnings, self.weights

    def __setstate__(self, state):
        self.__init__(*state)

    def score(self, text: str) -> float:
        if self.grammar is None:
            self.grammar = Grammar(self.beginnings)
        levels = self.grammar.levels(text)
        if levels not in self.known:
            z = float((_design(np.array([levels])) @ self.weights)[0])
            self.known[levels] = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
        return self.known[levels]


def held_out(id_col: str = "doc_id") -> Column:
    """The fold that is never learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def beginnings_of(text: str) -> list[str]:
    """Distinct beginnings of the text's words, the whole short words among them."""
    out = set()
    for token in set(tokens(text)):
        word = token.decode("utf-8", "ignore")
        if len(word) >= SHORTEST and not word[0].isdigit():
            out.update(word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1))
    return sorted(out)


def near_copy_key(text: str) -> int:
    """The smallest hash of the text's five-word shingles: equal for most near copies."""
    words = [t for t in tokens(text) if t != b"."]
    return min((xxhash.xxh64_intdigest(b" ".join(words[i:i + 5])) for i in range(max(1, len(words) - 4))), default=0) >> 1


def choose_beginnings(rows: list[tuple[str, int, int]], n1: int, n0: int) -> dict[str, str]:
    """beginning -> strong or weak, from (beginning, toxic texts, other texts)."""
    count = {b: (a, o) for b, a, o in rows}
    kept_by = {}
    for b, (a, _) in count.items():
        kept_by[b[:-1]] = max(kept_by.get(b[:-1], 0), a)
    chosen: dict[str, str] = {}
    for b in sorted(count, key=lambda b: (len(b), b)):
        a, o = count[b]
        ratio = lambda more: (a + 0.5) / (n1 + 1) / ((o + more) / (n0 + 1))
        if (any(b[:n] in chosen for n in range(SHORTEST, len(b))) or kept_by.get(b, 0) >= KEPT_BY_LONGER * a
                or ratio(0.5) < LEAST_RATIO):
            continue
        chosen[b] = STRONG if ratio(1.0) >= STRONG_RATIO else WEAK
    return chosen


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Fit the lexicon and the weights on labelled rows outside the held-out fold."""
    ship_package(documents.sparkSession)
    judged = labels.where("toxic is not null").groupBy("doc_id").agg(F.max(F.expr("int(toxic = 1)")).alias("y"))
    learnt = documents.where(~held_out()).select("doc_id", text_or_empty("text").alias("text")).withColumn(
        "h", F.xxhash64("text"))
    # ids and hashes meet their labels, whole texts do not travel; two labels: at most 2 * sample_rows hashes
    chosen = learnt.select("doc_id", "h").join(judged, "doc_id").groupBy(
        "y", F.pmod("h", F.lit(sample_rows)).alias("b")).agg(
        F.min("h").alias("h"), F.count(F.lit(1)).alias("rows")).select("y", "h", "rows")
    near = F.pandas_udf(lambda texts: texts.map(near_copy_key), "bigint")
    # first by hash, one copy of a text, then one text of those that share the smallest shingle
    texts = learnt.join(F.broadcast(chosen), "h").groupBy("y", "h").agg(
        F.min("text").alias("text"), F.first("rows").alias("rows"))
    sample = stage(texts.withColumn("near", near.asNondeterministic()("text")).groupBy("y", "near").agg(
        F.min(F.struct("h", "text")).alias("t"), F.sum("rows").alias("rows")).select("y", "t.text", "rows"), "toxic_sample")
    size = {r.y: (r.n, r.rows) for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows")).collect()}
    (n0, all0), (n1, all1) = size.get(0, (0, 0)), size.get(1, (0, 0))
    beginnings: dict[str, str] = {}
    if n1:
        parts = F.pandas_udf(lambda texts: texts.map(beginnings_of), "array<string>")
        counts = sample.select("y", F.explode(parts.asNondeterministic()("text")).alias("b")).groupBy("b").agg(
            F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("o"))
        share = f"((a + o) / {n1 + n0}D)"
        z = f"(a / {n1}D - o / {max(n0, 1)}D) / sqrt({share} * (1 - {share}) * {1 / n1 + 1 / max(n0, 1)!r}D + 1e-12D)"
        kept = counts.where(f"a >= {LEAST_TEXTS} and {z} >= {LEAST_Z}").collect()     # of a bounded sample
        beginnings = choose_beginnings([(r.b, r.a, r.o) for r in kept], n1, n0)
    shared = documents.sparkSession.sparkContext.broadcast(beginnings)

    @F.pandas_udf("array<int>")
    def levels(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grammar = Grammar(shared.value)
        for batch in texts:
            yield batch.map(lambda t: list(grammar.levels(t)))

    # a row for each combination of levels that occurs
    cells = sample.select("y", "rows", levels.asNondeterministic()("text").alias("v")).groupBy("v").agg(
        F.sum(F.col("y")).alias("a"), F.sum(1 - F.col("y")).alias("o")).collect()
    back = lambda every, n: every / n if n else 0.0  # noqa: E731  a sampled row stands for so many
    w1, w0 = back(all1, n1), back(all0, n0)
    scale = (n1 + n0) / max(1e-9, n1 * w1 + n0 * w0)          # as many rows in all as were read
    weights = fit(np.array([c.v for c in cells], dtype=float).reshape(-1, len(KINDS)),
                  np.array([c.a * w1 * scale for c in cells]), np.array([c.o * w0 * scale for c in cells]))
    return ToxicityModel(beginnings, weights)


PREDICT_FROM = 0.7


def score_toxicity(df: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) to every row."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)    # a word list and 19 weights

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield batch.map(shared.value.score).astype(float)

    return df.withColumn("score", scored(text_or_empty(text_col)))


def toxic_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document the fold, the score and the prediction."""
    rows = documents.select("doc_id", "text", held_out().alias("held_out"))
    return score_toxicity(rows, train(documents, labels)).select(
        "doc_id", "held_out", "score", F.expr(f"int(score >= {PREDICT_FROM})").alias("predicted"))
