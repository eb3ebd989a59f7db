"""BPE against tiktoken, longest-match counts against a greedy loop, round trips."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from retail_lake.llm.bpe import BytePairEncoder, Tokenizer, encoded_digests, load_ranks
from retail_lake.llm.tokencount import LongestMatchCounter, count_tokens

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = load_ranks(PATH)
SIGNS = ["ab", "aeiou rst", "éèàç  \n\t", "日本語", "abc 0123", " \n", " a\n b\u3000\x85\xa0\x1c", "'s 'll don't I'm²½Ⅷ"]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def _texts():
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(rnd.choice(SIGNS)) for _ in range(rnd.randint(0, 50))) for _ in range(3000)]
    return texts + ["a" * 5000, " " * 5000, "ab" * 3000, "é" * 3000, "<|endoftext|>"]


def test_encoder_equals_the_merge_loop_and_round_trips(reference):
    encoder = BytePairEncoder(RANKS, public_tokenizers.PATTERN)
    for t in _texts():
        ids = encoder.encode(t)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == reference.encode_ordinary(t), t[:80]
        assert encoder.decode(ids) == t.encode()


def test_counts_equal_a_greedy_loop():
    counter = LongestMatchCounter(sorted(RANKS), public_tokenizers.PATTERN)

    def greedy(w):
        n = i = 0
        while i < len(w):
            i = next(j for j in range(min(len(w), i + 40), i, -1) if w[i:j] in RANKS)
            n += 1
        return n

    for t in _texts()[:1500]:
        w = counter.findall(t)
        assert counter.count(t) == (len(w), sum(greedy(x.encode()) for x in w))


def test_counter_needs_every_byte():
    with pytest.raises(ValueError):
        LongestMatchCounter([b"a", b"ab"], public_tokenizers.PATTERN)


def test_documents(spark, odd_docs, reference):
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encoded_digests(spark, odd_docs).collect()}
    for r in odd_docs.collect():
        t = r.text or ""
        ids = reference.encode_ordinary(t)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert (r.doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) in got
    tokenizer = Tokenizer(spark)
    both = tokenizer.decode(tokenizer.encode(odd_docs)).collect()
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in both) and "score" in both[0]
    assert encoded_digests(spark, odd_docs.limit(0)).count() == 0


def test_count_tokens(spark, odd_docs):
    rows = count_tokens(spark, odd_docs).collect()
    assert len(rows) == 9 and {(r.n_words, r.n_pieces) for r in rows if r.doc_id in (1, 2)} == {(0, 0)}
    assert count_tokens(spark, odd_docs.limit(0)).count() == 0
