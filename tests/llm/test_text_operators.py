"""Language ID, decontamination, license scan and SimHash against brute force and held-out accuracy."""

import re
import unicodedata
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from retail_lake.llm import decontaminate, langid, licenses, simhash
from retail_lake.llm.components import components

SF = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _docs(spark, d=SF):
    return spark.read.parquet(f"{d}/documents.parquet")


def test_language_held_out_accuracy(spark):
    docs = _docs(spark, SF_MID)
    got = langid.predicted_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(got) == 1000 and len(held) > 100
    assert (held.lang_pred == held.lang).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_language_edge_cases(spark, odd_docs):
    got = {(r.doc_id, r.lang_pred) for r in langid.predicted_languages(odd_docs).collect()}
    assert {(1, "und"), (2, "und"), (6, "und"), (8, "und")} <= got
    kept = langid.keep_identified(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == 5
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.predicted_languages(unlabelled).collect()} == {"und"}
    assert langid.predicted_languages(odd_docs.limit(0)).count() == 0


def test_training_rows_do_not_grow_with_the_labels(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(langid, "LanguageModel", lambda x, langs: fitted.append(langs))
    monkeypatch.setattr(langid, "TRAIN_ROWS", 50)
    for labels in (2, 20):
        langid.train(spark.range(1000).selectExpr("id AS doc_id", "concat('some words ', id) AS text",
                                                  f"concat('l', id % {labels}) AS lang"), rows_per_lang=30)
        assert 20 <= len(fitted[-1]) <= 50 and len(set(fitted[-1])) == labels


def test_a_dirty_label_column_is_bounded(spark, monkeypatch):
    """20,000 labels: the most frequent ones are learnt, every row is predicted."""
    monkeypatch.setattr(langid, "LABELS", 3)
    docs = spark.range(20400).selectExpr(
        "id AS doc_id", "if(id < 200, concat('the cat sat ', id), if(id < 400, concat('der hund lief ', id), concat('x', id))) AS text",
        "if(id < 200, 'en', if(id < 400, 'de', concat('label', lpad(id, 6, '0')))) AS lang")
    got = {r.doc_id: r.lang_pred for r in langid.predicted_languages(docs).collect()}
    assert len(got) == 20400 and len(set(got.values())) <= 3
    assert sum(got[i] == "en" for i in range(200)) > 190 and sum(got[i] == "de" for i in range(200, 400)) > 190


def test_machines_equal_a_plain_svm():
    """Dual coordinate descent reaches the optimum that plain gradient steps on the primal find."""
    rng = np.random.default_rng(2)
    x = np.ones((60, langid.DIMENSIONS + 1), dtype=np.float32)
    x[:, :-1] = 0
    x[:, :6] = rng.standard_normal((60, 6))
    y = np.sign(x[:, 0] + 0.3 * rng.standard_normal(60)).astype(float)
    y[:10] = 0                                               # rows of other languages
    w = langid.linear_svm(x, y, passes=3000)
    use, d = y != 0, [0, 1, 2, 3, 4, 5, langid.DIMENSIONS]
    a, b, v = x[use][:, d].astype(float), y[use], np.zeros(7)
    for _ in range(60000):
        v -= 5e-4 * (v - 20 * (np.maximum(0, 1 - b * (a @ v)) * b) @ a)
    assert np.allclose(w[d], v, atol=1e-3)



def test_numeric_signs_are_no_letters(spark):
    signs = "\u00b2 \u00bd \u2167 \u2460"                    # superscript two, one half, Roman eight, circled one
    for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000)]):
        assert langid.has_letter(c) == (unicodedata.category(c)[0] == "L"), hex(ord(c))
    rows = [(90001, signs, "en"), (90002, signs + " \u00e9", "en"), (90003, "\u4f60", "en")]
    docs = _docs(spark).select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    pred = {r.doc_id: r.lang_pred for r in langid.predicted_languages(docs).where("doc_id > 90000").collect()}
    assert pred[90001] == "und" and pred[90002] != "und" and pred[90003] != "und"
    kept = {r.doc_id for r in langid.keep_identified(docs).where("doc_id > 90000").collect()}
    assert kept == {90002, 90003}


def test_features_do_not_depend_on_slices(monkeypatch):
    text = "Ein längerer Satz, the whole text. " * 50
    whole = langid.features(text)
    monkeypatch.setattr(langid, "_STEP", 17)
    assert np.allclose(whole, langid.features(text))


def test_decontamination_equals_brute_force(spark):
    docs, bench = _docs(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    odd = spark.createDataFrame([(900, "one two"), (901, ""), (902, None), (903, "... !!"), (None, "one two three four five six")],
                                "item_id bigint, text string")
    more = spark.createDataFrame([(70001, "zero one two three four five six"), (70002, None), (70003, "ONE, two")],
                                 "doc_id bigint, text string")
    docs, bench = docs.select("doc_id", "text").unionByName(more), bench.unionByName(odd)
    got = {(r.doc_id, r.item_id, r.matched, r.n_shingles) for r in decontaminate.contaminations(docs, bench).collect()}
    items = []
    for r in bench.collect():
        w = WORD.findall((r.text or "").encode().lower())
        if w:
            n = min(5, len(w))
            items.append((r.item_id, n, {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}))
    want = set()
    for r in docs.collect():
        w = WORD.findall((r.text or "").encode().lower())
        own = {n: {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} for n in range(1, 6)}
        for item, n, s in items:
            m = len(s & own[n])
            if m >= 0.8 * len(s) - 1e-9:
                want.add((r.doc_id, item, m, len(s)))
    assert got == want and (70003, 900, 1, 1) in got
    kept = decontaminate.keep_clean(docs, bench)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - {x[0] for x in want}


def test_decontamination_in_blocks(spark, monkeypatch):
    docs, bench = _docs(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(map(tuple, decontaminate.contaminations(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 20)
    assert sorted(map(tuple, decontaminate.contaminations(docs, bench).collect())) == whole
    assert decontaminate.contaminations(docs, bench.limit(0)).count() == 0
    thrice = bench.unionByName(bench).unionByName(bench)     # repeated items are reported each
    assert sorted(map(tuple, decontaminate.contaminations(docs, thrice).collect())) == sorted(whole * 3)


def test_decontamination_holds_one_block_at_a_time(spark, odd_docs, monkeypatch):
    docs, bench = _docs(spark).unionByName(odd_docs, allowMissingColumns=True), spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(decontaminate.keep_clean(docs, bench).collect(), key=str)
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 20)
    parts = [decontaminate.keep_clean(docs, bench), decontaminate.contaminations(docs, bench)]
    assert len(decontaminate._blocks(bench, "item_id", "text")) > 1
    for df in parts:                                         # all blocks are searched and written, none is still held
        assert "EvalPython" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(parts[0].collect(), key=str) == whole and parts[0].columns == docs.columns


def test_license_passage_is_found_by_any_of_its_words(spark):
    text, label, _ = licenses.PASSAGES[2]
    rare = ["program", "free", "redistribute", "modify"]     # outside the key phrase, and all four differ
    other = " ".join("other" if w in rare else w for w in text.split())
    index = licenses.PositionalIndex({w.encode(): 9.0 if w in rare else 1.0 for w in text.split()})
    for words in (text, other):
        assert (False, label, 2, 24) in [s[:4] for s in index.scan("x y " + words + " z")[1]]
    for number, (passage, name, key) in enumerate(licenses.PASSAGES):
        w = passage.split()
        for lost in range(len(w)):                           # any run of as many words as may differ
            bad = {i % len(w) for i in range(lost, lost + len(w) - -(-len(w) * 4 // 5))}
            changed = " ".join("other" if i in bad else x for i, x in enumerate(w))
            if key in changed:
                assert name in [s[1] for s in index.scan(changed)[1]], (number, changed)
    docs = spark.createDataFrame([(1, "a under the MIT license, b " + text)], "doc_id bigint, text string")
    spans = licenses.license_spans(docs).collect()[0].spans
    assert [(s.is_phrase, s.label, s.first_word, s.end_word) for s in spans] == [(True, "mit", 1, 5), (False, label, 6, 28)]


def test_license_base_places_equal_brute_force(spark, odd_docs):
    extra = spark.createDataFrame([
        (501, "Under the MIT license under the mit LICENSE, and CC-BY NC"),
        (502, "Permission is hereby granted, free of charge, to any person obtaining one copy of this software"),
        (503, "This work is licensed under the GNU General Public License, version 3."), (504, "the mit license")],
        "doc_id bigint, text string")
    docs = _docs(spark).select("doc_id", "text").unionByName(extra).unionByName(odd_docs.select("doc_id", "text"))
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                  for r in licenses.scan_licenses(docs).collect())
    want = Counter()
    for r in docs.collect():
        w = WORD.findall((r.text or "").encode().lower())
        places, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.encode().split()
            at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        want[(r.doc_id, len(w), len(places), min(places, default=None), max(places, default=None),
              ",".join(sorted(labels)))] += 1
    assert got == want
    labels = {r.doc_id: r.labels for r in licenses.scan_licenses(extra).collect()}
    assert labels == {501: "cc-by-nc,mit", 502: "mit", 503: "gpl-3", 504: ""}
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def _slow_fingerprint(text):
    w = [x for x in re.split(rb"[\x20\x09-\x0D]+", text.encode().lower()) if x]
    if not w:
        return 0
    s = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _roots(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash_components_equal_brute_force(spark, odd_docs):
    docs = _docs(spark).select("doc_id", "text").unionByName(
        odd_docs.where("doc_id is not null").select(F.expr("doc_id + 100000").alias("doc_id"), "text"))
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.document_components(docs).collect()}
    fps = {r.doc_id: _slow_fingerprint(r.text or "") for r in docs.collect()}
    ids = sorted(fps)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if (fps[a] ^ fps[b]).bit_count() <= 4]
    roots = _roots(links, ids)
    assert got == {(i, format(fps[i], "016x"), roots[i]) for i in ids}
    assert simhash.document_components(docs.limit(0)).count() == 0


def test_dense_fingerprint_groups_lose_no_link(spark):
    rng = np.random.default_rng(7)
    fps = []
    for _ in range(6):                                       # tight groups, chains and strangers
        centre = int(rng.integers(0, 2**63))
        for _ in range(80):
            fps.append(centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)))
    fps += [int(x) for x in rng.integers(0, 2**63, 200)]
    fps = sorted({x - (1 << 64) if x >> 63 else x for x in fps})
    got = {r.fp: r.comp for r in simhash.fingerprint_components(spark.createDataFrame([(x,) for x in fps], "fp bigint")).collect()}
    links = [(a, b) for k, a in enumerate(fps) for b in fps[k + 1:] if ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    assert got == _roots(links, fps)


def test_one_document_of_each_group_stays(spark, odd_docs):
    kept = simhash.keep_one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6, 7]


def test_near_duplicates_broadcast_nothing_that_grows(spark, monkeypatch):
    """Small files do not make Spark broadcast what grows with the documents (buckets, links, documents)."""
    from retail_lake.llm import components as links
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 50, 40)) for _ in range(30)]
    docs = spark.createDataFrame([(i, texts[i % 30] + " end" * (i % 3)) for i in range(90)], "doc_id bigint, text string")
    plans, write = [], simhash.stage

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df
    for module in (simhash, links):
        monkeypatch.setattr(module, "stage", lambda df, label: write(planned(df), label))
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) >= 1 << 20
    near, kept = planned(simhash.near_duplicates(docs)), simhash.keep_one_of_each(docs)
    assert near.count() == 90 and {r.doc_id for r in kept.collect()} == {r.component_id for r in near.collect()}
    assert any("Generate explode" in p for p in plans)
    assert not [p for p in plans if "Broadcast" in p]
    last = kept._jdf.queryExecution().executedPlan().toString()       # row numbers may be, where they are few
    assert "LeftSemi" in last and "BuildLeft" not in last


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}, 201: 200}
