"""The pipeline against brute force, stage by stage."""

import re

import corpus_pipeline
import xxhash

SF = "/root/testdata/sf0.001"


def _fingerprint(text):
    w = [x for x in re.split(rb"[\x20\x09-\x0D]+", text.encode().lower()) if x]
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_run_keeps_what_brute_force_keeps(spark, con):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*docs.columns, "token_ids", "n_tokens"]
    kept = [r for r in docs.orderBy("doc_id").collect() if re.search(r"[^\W\d_]", r.text or "")]
    group, fps = {}, {r.doc_id: _fingerprint(r.text) for r in kept}
    for r in kept:                                           # flood fill over links of at most four bits
        if r.doc_id in group:
            continue
        todo = [r.doc_id]
        while todo:
            a = todo.pop()
            group[a] = r.doc_id
            todo += [b for b in fps if b not in group and (fps[a] ^ fps[b]).bit_count() <= 4]
    firsts = {d for d, g in group.items() if d == g}
    from retail_lake.llm.decontaminate import ORACLE_SQL
    dirty = {x[0] for x in con.sql(ORACLE_SQL).fetchall()}
    assert {r.doc_id for r in out.select("doc_id").collect()} == firsts - dirty


def test_stages_take_odd_rows(spark, odd_docs):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != "byte_bpe":
            assert docs.columns == odd_docs.columns
    assert sorted(r.doc_id for r in docs.collect()) == [4, 5, 7]
    empty = odd_docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_stages_keep_columns_named_like_helpers(spark):
    """Values of extra columns go through all stages but the last, which replaces its own outputs."""
    names = ["__text", "__doc", "__lang", "__both", "lang_pred", "score"]
    docs = spark.createDataFrame([(i, f"the cat {'sat ' * (i + 9)} on mat number {i} {'abc' * i}", "en", "a", 3,
                                   *[f"{n}{i}" for n in names]) for i in range(4)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                 + ", ".join(f"`{n}` string" for n in names))
    from retail_lake.llm.langid import keep_identified
    rows = keep_identified(docs).collect()
    assert len(rows) == 4 and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)
