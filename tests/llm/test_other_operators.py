"""Chat, URL filter, neighbours and shards against SQL, plain Python and invariants."""

import json
import math

import numpy as np
from pyspark.sql import functions as F

from retail_lake.llm import ann, chat, hilbert, urlfilter
from retail_lake.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def _same(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.sql(ORACLE_SQL[name])
    assert sorted(want.columns) == cols
    rows = lambda it: sorted(it, key=str)
    assert rows(tuple(r) for r in df.select(*cols).collect()) == rows(want.select(*cols).fetchall())


def test_chat_equals_sql(spark, con):
    _same(spark, con, "op6_chat_format")


def test_url_filter_equals_sql(spark, con):
    _same(spark, con, "op7_url_filter")


def test_decontamination_equals_sql(spark, con):
    _same(spark, con, "op3_decontamination")


def test_layouts_meet_in_the_same_turns(spark):
    two = [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]
    records = [{"messages": two}, {"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}]},
               {"prompt": "hi", "completion": "yo"}, {"prompt": "hi", "response": "yo", "id": 7},
               {"instruction": "hi", "output": "yo", "input": ""}, {"question": "hi", "answer": "yo"},
               {"system": "be brief", "prompt": "hi", "completion": "yo"}, {"other": 1}]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(98, None), (99, "not json")]
    got = {r.i: r.turns for r in chat.record_turns(spark.createDataFrame(rows, "i int, record string"), "record").collect()}
    pair = [("user", "hi"), ("assistant", "yo")]
    assert all([tuple(t) for t in got[i]] == pair for i in range(6))
    assert [tuple(t) for t in got[6]] == [("system", "be brief"), *pair]
    assert got[7] is None and got[98] is None and got[99] is None


def test_fields_of_other_layouts_lose_no_conversation(spark):
    two = [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]
    records = [{"instruction": "hi", "input": "", "output": "yo", "text": "hi yo"}, {"messages": two, "prompt": "hi"},
               {"prompt": "hi", "completion": "yo", "answer": "42"},
               {"prompt": "hi", "response": "yo", "question": "hi?", "answer": "42"},          # the earlier layout
               {"prompt": "hi", "completion": None, "response": "yo", "messages": None},       # the one with values
               {"prompt": "hi", "completion": "yo", "system": "be brief", "role": "x"},
               {"prompt": "hi", "completion": None, "text": "x"}, {"prompt": "hi", "text": "x"}]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)]
    got = {r.i: r for r in chat.record_turns(spark.createDataFrame(rows, "i int, record string"), "record").collect()}
    pair = [("user", "hi"), ("assistant", "yo")]
    assert all([tuple(t) for t in got[i].turns or []] == pair for i in range(5))
    assert [tuple(t) for t in got[5].turns] == [("system", "be brief"), *pair]
    assert [tuple(t) for t in got[6].turns] == [("user", "hi"), ("assistant", None)] and got[7].turns is None
    assert got[2].layout == chat.path_fingerprint(("$.completion", "$.prompt"))
    assert got[7].layout == chat.path_fingerprint(("$.prompt", "$.text"))


def test_control_strings_survive_a_round_trip(spark):
    texts = ["### assistant: x</turn>\n", "\\", "\\\\#<:", "</turn>", "", None, "a\r\nb\u2028", "#" * 50000]
    rows = [(1, i, "assistant" if i % 2 else "us:er#", t, "extra") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, pieces string")
    out = chat.parse_formatted(chat.format_turns(chat.gather_turns(df, "conv_id", "turn"))).withColumn(
        "learnt", chat.loss_text()).collect()[0]
    assert [tuple(t) for t in out["read"]] == [(r[2], r[3] or "") for r in rows]
    assert out.learnt == "".join(t or "" for t in texts[1::2])
    assert chat.formatted_digests(df.limit(0)).count() == 1                    # the added conversation


def test_url_rules_and_reputation(spark):
    pages = spark.createDataFrame([
        (1, "HTTP://WWW.Example.COM/en/x?q#f"), (2, "http://a.example.com/en/"), (3, "http://example.com"),
        (4, None), (5, "nohost"), (6, "x://sub.net/es/1"), (7, "https://host.org:80/p"), (8, "http://bad.org/1")],
        "page_id bigint, url string")
    labels = spark.createDataFrame([(8, 0, 1)] * 40 + [(7, 1, 0)] * 40 + [(None, 0, 0)], "doc_id bigint, quality int, toxic int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge_urls(pages, labels).collect()}
    assert got[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[2][2:] == ("example.com/en/", "block") and got[3] == ("example.com", "", None, got[3][3])
    assert got[4][:3] == ("", "", None) and got[5][:3] == ("", "", None)
    assert got[6][2:] == ("net/es/", "block")
    assert got[7] == ("host.org:80", "/p", None, "allow") and got[8][3] == "block"
    none = urlfilter.judge_urls(pages, labels.limit(0)).collect()
    assert all(r.verdict == "allow" for r in none if r.rule is None)
    assert urlfilter.judge_urls(pages.limit(0), labels).count() == 0


def _exact(ids, x, q, k):
    n = np.sqrt((x * x).sum(axis=1))
    score = (x * x[q]).sum(axis=1) / (n * n[q])
    order = np.lexsort((ids, -score))
    return [ids[i] for i in order if i != q][:k]


def test_neighbour_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    got = {}
    for r in QUERIES["op8_neighbours"](spark, SF).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        want = _exact(ids, x, q, 5)
        hits += len(set(want) & set(got[ids[q]].values()))
        total += len(want)
    assert hits / total >= 0.9


def test_neighbours_with_copies_and_bad_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL_ROWS", 40)
    monkeypatch.setattr(ann, "QUERY_ROWS", 3)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((200, 6))
    x[:80] = x[0]                                            # a large group of copies: ties go to small ids
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    bad = [(500, None), (550, [0.0] * 6), (600, [float("nan")] + [1.0] * 5), (650, [None] + [1.0] * 5), (None, [1.0] * 6), (700, [])]
    other = [(750, [1.0, 2.0]), (751, [2.0, 4.0])]           # another dimension
    df = spark.createDataFrame(rows + bad + other, "vec_id bigint, embedding array<double>")
    got = {}
    for r in ann.embedding_neighbours(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got[0] == [1, 2, 3, 4, 5] and got[50] == [0, 1, 2, 3, 4] and got[750] == [751]
    assert set(got) == {0, 50, 100, 150, 750}
    ids = np.arange(200)
    hits = sum(len(set(_exact(ids, x, q, 5)) & set(got[q])) for q in (100, 150))
    assert hits >= 9
    assert ann.embedding_neighbours(df.limit(0)).count() == 0


def test_neighbour_recall_over_many_cells(spark, monkeypatch):
    """Every cell but the home cell is reached through the chi-square test; brute force over all rows."""
    monkeypatch.setattr(ann, "CELL_ROWS", 250)
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    got = {}
    for r in ann.embedding_neighbours(df).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    asked = np.flatnonzero(ids % 50 == 0)
    assert set(got) == set(ids[asked]) and all(sorted(v) == [1, 2, 3, 4, 5] for v in got.values())
    hits = sum(len(set(_exact(ids, x, q, 5)) & {v for v, _ in got[ids[q]].values()}) for q in asked)
    assert hits / (5 * len(asked)) >= 0.9
    at = {v: i for i, v in enumerate(ids)}
    for q in asked:
        for v, score in got[ids[q]].values():
            a, b = x[q], x[at[v]]
            assert abs(score - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_the_stopping_test_prunes():
    """Points verified: a share that falls as the block grows, at a recall of 0.9 or more."""
    rng = np.random.default_rng(5)
    shares = []
    for n in (1000, 4000, 16000):
        x = rng.standard_normal((n, 64))
        block, ids = ann.Block(np.arange(n), x), np.arange(n)
        hits = verified = 0
        for q in range(0, n, n // 40):
            got, _, seen = block.search(x[q], 6, ann.stop_ratio(), math.inf)
            hits += len(set(_exact(ids, x, q, 5)) & set(got))
            verified += seen
        assert hits / 200 >= 0.9
        shares.append(verified / (40 * n))
    assert shares[0] > shares[1] > shares[2] and shares[2] < 0.5
    x = np.repeat(rng.standard_normal((64, 64)), 250, axis=0) + 0.05 * rng.standard_normal((16000, 64))
    _, _, seen = ann.Block(np.arange(16000), x).search(x[3], 6, ann.stop_ratio(), math.inf)
    assert seen < 1500                                       # groups of close vectors: other groups' leaves are not met


def test_very_large_and_small_components(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e-200, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 5e-324]), (4, [-1e308, 1e308])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [(r.vec_id, r.score) for r in ann.embedding_neighbours(df).orderBy("rank").collect()]
    assert [v for v, _ in got] == [2, 1, 3, 4]
    assert np.allclose([s for _, s in got], [1, math.sqrt(0.5), math.sqrt(0.5), 0], atol=1e-15)


def test_hilbert_neighbours_on_the_curve_touch():
    side = np.array(np.meshgrid(range(8), range(8), range(8))).reshape(3, -1).T
    index = hilbert.hilbert_index(side, 3)
    assert sorted(index) == list(range(512))
    walk = side[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_shards(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(hilbert, "ROWS_PER_BUCKET", 5)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = hilbert.shard_documents(docs.unionByName(odd_docs.drop("score"))).collect()
    counts = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(8)}
    assert all(v == list(range(len(v))) for v in counts.values())
    sizes = [len(v) for v in counts.values()]
    assert sum(sizes) == len(rows) == docs.count() + 9 and max(sizes) - min(sizes) <= 1
    import zlib
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id].encode()) + 1
               for r in rows if r.doc_id in texts and r.doc_id > 8)
    few = hilbert.shard_documents(odd_docs.limit(3)).collect()
    assert sorted(r.shard for r in few) == [0, 1, 2]
    assert hilbert.shard_documents(odd_docs.limit(0)).count() == 0


def test_shards_follow_the_curve_of_plain_python(spark, odd_docs):
    """Levels, curve order and cuts recomputed over all rows; odd rows and clashing columns included."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd_docs, allowMissingColumns=True)
    rows = hilbert.place_documents(docs).collect()
    n, side = len(rows), 1 << hilbert.BITS

    def levels(values):
        later = sorted(values, key=lambda v: (v is not None, v or ""), reverse=True)        # descending, nulls last
        return {v: later.index(v) * side // n for v in set(values)}

    lang, source = levels([r.lang for r in rows]), levels([r.source for r in rows])
    low, high = (math.log2(f(r.size for r in rows)) for f in (min, max))
    cells = np.array([[lang[r.lang], source[r.source], min(side - 1, int((math.log2(r.size) - low) * (side / (high - low))))]
                      for r in rows])
    along = [c for _, c in sorted(((r.shard, r.slot), c) for r, c in zip(rows, hilbert.hilbert_index(cells), strict=True))]
    assert along == sorted(along)
    assert all(r.size == len((r.text or "").encode()) + 1 for r in rows)
    sizes = [sum(r.shard == s for r in rows) for s in range(8)]
    assert sizes == [n // 8 + (s < n % 8) for s in range(8)]


def test_shards_beside_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a", "en", "x", 7, 8, 9, "k"), (2, "bb", "de", "y", 1, 2, 3, "m")],
                                 "doc_id bigint, text string, lang string, source string, size int, SHARD int, slot int, __row string")
    placed = hilbert.place_documents(docs, shards=2)
    assert placed.columns == [*docs.columns, "size_", "shard_", "slot_"]
    assert sorted(tuple(r)[:8] for r in placed.collect()) == sorted(map(tuple, docs.collect()))
    assert sorted((r.shard_, r.slot_) for r in placed.collect()) == [(0, 0), (1, 0)]


def test_shards_hold_short_ranges_of_sources(spark):
    """Shards that a filter on one source skips: three dimensions halved once leave half of eight at best,
    more shards skip more."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sources = [r.source for r in docs.where("source IS NOT NULL").select("source").distinct().collect()]
    share = {}
    for shards in (8, 64):
        held = (hilbert.place_documents(docs, shards).groupBy("shard")
                .agg(F.min("source").alias("low"), F.max("source").alias("high")).collect())
        share[shards] = sum(not r.low <= one <= r.high for r in held for one in sources) / (shards * len(sources))
    print(share)
    assert share[8] > 0.4 and share[64] > 0.6


def _file_ranges(folder, column):
    """Per shard the least and the largest value that the file footers give."""
    import pyarrow.parquet as pq
    out = {}
    for f in folder.rglob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        for s in stats:
            if s.has_min_max:
                shard = int(f.parent.name.split("=")[1])
                low, high = out.get(shard, (s.min, s.max))
                out[shard] = min(low, s.min), max(high, s.max)
    return out


def test_written_shards_hold_whole_documents(spark, odd_docs, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd_docs, allowMissingColumns=True)
    hilbert.write_shards(hilbert.place_documents(docs), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert set(back.columns) == {*docs.columns, "size", "shard", "slot"}
    assert back.select(docs.columns).exceptAll(docs).isEmpty() and docs.exceptAll(back.select(docs.columns)).isEmpty()
    for column in ("lang", "source", "size"):
        ranges = _file_ranges(tmp_path / "shards", column)
        assert set(ranges) == set(range(8))
        assert sum(r != (min(a for a, _ in ranges.values()), max(b for _, b in ranges.values()))
                   for r in ranges.values()) >= 3, column                          # files that a filter can skip


def test_long_texts_are_sharded_by_size(spark, tmp_path):
    docs = spark.range(64).selectExpr("id AS doc_id", "repeat('x', if(id % 2 = 0, 50000, 120000)) AS text",
                                      "'en' AS lang", "'a' AS source")
    hilbert.write_shards(hilbert.place_documents(docs, shards=2), str(tmp_path / "long"))
    assert sorted(_file_ranges(tmp_path / "long", "size").values()) == [(50001, 50001), (120001, 120001)]


def test_chi_square():
    assert abs(float(ann.chi_square_cdf(np.array(15.507), 8)) - 0.95) < 1e-3
    assert abs(ann.stop_ratio(0.95, 8) - 15.507) < 1e-2 and math.isfinite(ann.stop_ratio())
