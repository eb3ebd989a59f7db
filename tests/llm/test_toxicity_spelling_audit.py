"""Toxicity grammar, spelling variants and filter audit: brute force, SQL, held-out accuracy, odd rows."""

import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from retail_lake.llm import filteraudit, spelling, toxicity
from retail_lake.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ toxicity
def _kinds(text, **beginnings):
    return dict(toxicity.Grammar(beginnings).kinds(text))


def test_clauses_are_matched_not_words():
    assert _kinds("the idiot") == {"strong": 1}
    assert _kinds("You absolute idiot, loser!") == {"strong_targeted": 1}
    assert _kinds("idiot and loser") == {"strong_repeated": 1}
    assert _kinds("idiot. and loser") == {"strong": 2}
    assert _kinds("he is not an idiot") == {"negated": 1}
    assert _kinds("he isn't stupid") == {"negated": 1}
    assert _kinds("not a word of what that man there told the idiot") == {"reported": 1}
    assert _kinds("not in the least, it was simply an idiot") == {"strong": 1}
    assert _kinds('she said: you are an idiot. Yes') == {"reported": 1}
    assert _kinds('"you idiot" was the answer') == {"reported": 1}
    assert _kinds("I will kill you") == {"menace": 1}
    assert _kinds("kill the process") == {"threat": 1}
    assert _kinds("") == {} and _kinds(" \n . \" ") == {} and _kinds("idiotic? IDIOT") == {"strong": 2}
    assert _kinds("ein loweichen", lowei="s") == {"strong": 1}
    assert _kinds("ein loweichen und loweient", lowei="w") == {"weak_repeated": 1}


symbols = st.text(alphabet="oswhtnrq#", max_size=14)
PARTS = [toxicity.negation_machine(), toxicity.reported_machine(), toxicity.clause_machine()]
COMPOSED = PARTS[0].then(PARTS[1]).then(PARTS[2])
GRAMMAR = toxicity.Grammar()


@given(symbols)
@settings(max_examples=300, deadline=None)
def test_composition_equals_the_cascade(line):
    line += "#"

    def run(machine, read):
        state, out = machine.start, []
        for a in read:
            state, written = machine.arcs[state, a]
            out.extend(written)
        return out

    read = line
    for m in PARTS:
        read = run(m, read)
    assert run(COMPOSED, line) == read
    # and the fast path, which skips clauses without a match
    fast = GRAMMAR.read(line)
    assert fast == Counter(read)


def test_beginnings_stand_for_their_inflections():
    rows = [("low", 50, 0), ("lowe", 50, 0), ("lowei", 50, 0), ("loweis", 20, 0), ("the", 60, 600), ("rar", 4, 0),
            ("ach", 40, 60), ("achl", 30, 20)]
    got = toxicity.choose_beginnings(rows, 60, 600)
    assert got["lowei"] == "s" and "low" not in got and "loweis" not in got and "the" not in got
    assert got.get("achl") == "w"


def test_fit_keeps_priors_for_what_it_never_saw():
    levels = np.zeros((2, len(toxicity.KINDS)))
    strong = list(toxicity.KINDS).index("strong")
    levels[1, strong] = 1
    w = toxicity.fit(levels, np.array([5.0, 40.0]), np.array([500.0, 0.0]))
    p = 1 / (1 + np.exp(-toxicity._design(levels) @ w))
    assert p[0] < 0.05 and p[1] > 0.7
    other = 1 + list(toxicity.KINDS).index("reported")
    assert w[other] == pytest.approx(toxicity.prior()[other])
    assert (toxicity.fit(np.zeros((0, 9)), np.zeros(0), np.zeros(0)) == toxicity.prior()).all()


def test_held_out_documents(spark, con):
    got = {r.doc_id: r for r in QUERIES["op11_toxicity"](spark, MID).collect()}
    n, toxic = con.sql(f"SELECT (SELECT count(*) FROM '{MID}/documents.parquet'), list(doc_id) "
                       f"FROM '{MID}/labels.parquet' WHERE toxic = 1").fetchall()[0]
    assert len(got) == n
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.7)
    texts = dict(con.sql(f"SELECT doc_id, text FROM '{MID}/documents.parquet'").fetchall())
    insulting = {i for i in texts if len(re.findall(r"\b(?:idiot|moron|scum|trash|clown|stupid|loser)\b", texts[i])) > 1}
    assert insulting and all(got[i].predicted for i in insulting)
    clean = con.sql(f"SELECT list(doc_id) FROM '{MID}/labels.parquet' WHERE toxic = 0").fetchall()[0][0]
    assert sum(got[i].predicted for i in clean if got[i].held_out) <= 2
    assert insulting <= set(toxic) | set(texts) - set(clean)


def test_toxicity_of_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(4, 1, 1), (5, 0, 0), (5, None, 1), (None, 1, 1), (7, None, None), (99, 1, 1)],
                                   "doc_id bigint, quality int, toxic int")
    got = toxicity.toxic_documents(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    assert toxicity.toxic_documents(odd_docs.limit(0), labels).count() == 0
    assert toxicity.toxic_documents(odd_docs, labels.limit(0)).count() == odd_docs.count()


# ------------------------------------------------------------------ spelling
def _edit_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def _near_by_deletions(words):
    """All pairs one edit apart, by shared deletions: an independent way to the same pairs."""
    meet = {}
    for w in words:
        for v in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            meet.setdefault(v, []).append(w)
    return {tuple(sorted(p)) for ws in meet.values() for p in combinations(set(ws), 2) if _edit_one(*p)}


def _brute_force(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = {w: [] for w in words}
    for a, b in _near_by_deletions(words):
        near[a].append(b)
        near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def _rows(df):
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]


def test_variants_equal_brute_force_on_documents(spark, con):
    got = _rows(QUERIES["op12_spelling_variants"](spark, SF))
    want = _brute_force(con.sql("SELECT doc_id, text FROM documents").fetchall())
    assert len(got) == len(set(got)) and set(got) == want and any(x[1] for x in want)


@given(st.text(alphabet="abcÿ\u00c0z", min_size=1, max_size=12), st.integers(0, 11), st.sampled_from("abcÿ\u00c0z"))
def test_one_edit_flips_two_parities_at_most(word, at, letter):
    at %= len(word)
    for other in (word[:at] + word[at + 1:], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1:]):
        assert ((spelling.letter_parities(word) ^ spelling.letter_parities(other)) & (1 << 64) - 1).bit_count() <= 2


def test_near_words_of_few_letters(spark):
    """Many ties among bigrams, repeated bigrams, edits at both ends."""
    rng = np.random.default_rng(7)
    words = {"".join(rng.choice(list("abé"), size=int(rng.integers(7, 11)))) for _ in range(1500)}
    words |= {"aaaaaaa", "aaaaaaaa", "aaaaaaab", "baaaaaaa", "aaabaaaa", "abababa", "abababab", "bababab"}
    got = spelling.near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()
    got = [(r.a, r.b) for r in got]
    assert len(got) == len(set(got)) and set(got) == _near_by_deletions(words)


@given(st.text(alphabet="abcd", min_size=7, max_size=14), st.randoms(use_true_random=False))
@settings(max_examples=200, deadline=None)
def test_pivots_are_the_cheapest_disjoint_pair(word, rnd):
    grams = sorted({word[i:i + 2] for i in range(len(word) - 1)})
    counted = sorted((rnd.randint(1, 9), g) for g in grams)
    order = {g: (i, n) for i, (n, g) in enumerate(counted)}
    prefix = spelling.gram_prefix(word, order)
    cost = lambda ps: sum(order[word[p:p + 2]][1] for p in ps)
    pivots = spelling.choose_pivots(word, prefix, order)
    pairs = [p for p in combinations(prefix, 2) if p[1] - p[0] >= 2]
    assert tuple(pivots) in pairs and cost(pivots) == min(map(cost, pairs))


def test_roots_follow_long_chains_and_ties(spark):
    # each word one edit from the next, ten times as frequent
    chain = ["abcdefg", "abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk", "abcdefghijkl"]
    rows = [(w, 2 * 10 ** i) for i, w in enumerate(chain)] + [("abcdefx", 20), ("zzzzzzz", 5)]
    got = {x[0]: x for x in _rows(spelling.spelling_forms(spark.createDataFrame(rows, "word string, n bigint")))}
    assert got["abcdefg"][1] == "abcdefgh" and got["abcdefg"][2] == chain[-1]
    assert got["zzzzzzz"] == ("zzzzzzz", None, "zzzzzzz", 5, 0, None)
    assert got["abcdefx"][4] == 1 and got["abcdefx"][1] is None


def test_spelling_of_odd_rows(spark, odd_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    docs += [(None, "Größenwahn größenwahn GRÖSSENWAHN ÿÿÿÿÿÿÿ ÿÿÿÿÿÿÿ×÷")] * 3
    odd = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, word string")
    got = _rows(spelling.spelling_variants(odd))
    assert len(got) == len(set(got)) and set(got) == _brute_force(docs)
    assert spelling.spelling_variants(odd.limit(0)).count() == 0


# --------------------------------------------------------------------- audit
def _sql(documents, labels, tmp_path):
    import duckdb
    c = duckdb.connect()
    for name, df in (("documents", documents), ("labels", labels)):
        df.write.parquet(f"{tmp_path}/{name}")
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    cols = "part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley"
    return set(c.sql(f"SELECT {cols} FROM ({ORACLE_SQL['op13_filter_audit']})").fetchall())


def _audit(documents, labels):
    rows = filteraudit.audit_filters(documents, labels).collect()
    assert len(rows) == len({(r.part, r.filter_order, r.step) for r in rows})
    return {(r.part, r.filter_order, r.step, r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost,
             r.shapley) for r in rows}


def test_audit_of_odd_rows(spark, odd_docs, tmp_path):
    more = [(10, "AB" + "cd " * 300, None, "a", 1, "q"), (11, "AB" + "cd " * 300, None, "a", 1, "q"),
            (12, " ".join(map(str, range(250))) + " #", None, "a", 1, "q"), (13, "é x\x0by\x1cz " * 200, None, "", 1, "q"),
            (14, " ".join(map(str, range(250))), None, "a", 1, "q")]
    docs = odd_docs.unionByName(spark.createDataFrame(more, odd_docs.schema))
    labels = spark.createDataFrame([(10, 1, 0), (11, 1, 1), (12, None, 1), (12, 1, None), (14, 0, 0), (None, 1, 1), (77, 1, 1),
                                    (1, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = _audit(docs, labels)
    assert got == _sql(docs, labels, tmp_path)
    assert len(got) == 600 * len({r.source or "" for r in docs.collect()})
    assert _audit(docs.limit(0), labels) == set()
    assert len(_audit(docs, labels.limit(0))) == len(got)


def test_matrix_holds_every_word_count(spark, monkeypatch):
    monkeypatch.setattr(filteraudit, "SHARD_ROWS", 7)         # many shards
    monkeypatch.setattr(filteraudit, "BUCKET_WORDS", 3000)    # and buckets
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    matrix = filteraudit.document_term_matrix(docs).collect()
    words = sorted({w for r in docs.collect() for w in (r.text or "").encode().split()})
    unpack = filteraudit._unpack
    assert len({int(i) for m in matrix for i in unpack(m.columns, "<i8")}) == len(words)
    by_id = {}
    for m in matrix:
        ends, columns, counts = unpack(m.row_ends, "<i8"), unpack(m.columns, "<i8"), unpack(m.counts, "<i4")
        for d, lo, hi in zip(m.doc_ids, [0, *ends[:-1]], ends, strict=True):
            by_id[d] = dict(zip(columns[lo:hi].tolist(), counts[lo:hi].tolist(), strict=True))
    texts = {r.doc_id: Counter((r.text or "").encode().split()) for r in docs.collect()}
    assert {d: sorted(c.values()) for d, c in by_id.items()} == {d: sorted(c.values()) for d, c in texts.items()}
    seen = {}                                                 # one id for each word in whatever shard
    for d, c in texts.items():
        for w, n in c.items():
            holders = {i for i, k in by_id[d].items() if k == n}
            seen[w] = seen.get(w, holders) & holders
    assert all(seen.values())
