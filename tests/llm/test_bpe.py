"""Ids and decoded texts as the tokenizers library gives them."""
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from txwatch.llm import bpe as B

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, ids string, n_tokens int"
ODD = [None, "", " \n\t", "a", "aaaa aaaaaaa", "Don't WE'LL it's 'S", "x1234 5", "<|startoftext|>Hi<|endoftext|> <|endoftext",
       "ΣΑΣ ΟΔΟΣ İstanbul ẞ K", "é ́x é ä", "日本語テスト 🙂👍🏽 ½ ٣", "a\x1cb\x1d c\x85d e f​g",
       "=====>>>> !!!??? ...---", "z" * 3000, "abcabc" * 500, "word " * 5000, "&amp; http://x.example.com/?q=1#a"]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def same(texts, reference):
    got = B.bpe(PATH).encode(texts)
    for t, g in zip(texts, got, strict=True):
        ids = reference.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(g, "<u4").tolist() == ids, t[:200]
        assert B.bpe(PATH).decode(g) == reference.decode(ids, skip_special_tokens=False)


def test_odd_texts(reference):
    same([t or "" for t in ODD], reference)


def test_random_words(reference):
    rng = random.Random(5)
    vocab = [t.replace("</w>", "") for t in B.bpe(PATH).vocab]
    small = "aeiounrstlhdcmpgby'é0!-"
    texts = [" ".join("".join(rng.choices(small, k=rng.randint(1, 14))) for _ in range(200)) for _ in range(100)]
    texts += [" ".join("".join(rng.choices(vocab, k=rng.randint(1, 3))) for _ in range(200)) for _ in range(100)]
    same(texts, reference)


def test_some_words_fail_the_check_and_are_merged_exactly():
    b = B.bpe(PATH)
    rng = random.Random(1)
    words = ["".join(rng.choices("aeiounrstl", k=9)) for _ in range(2000)]
    exact = [b.exact(b.symbols(w + b.end)) for w in words]
    assert b.encode_words(words) == exact
    assert [b.propose(w) for w in words] != exact


def test_whole_table(spark, reference):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    rows = B.decode_ids(B.encode_texts(df, PATH), PATH).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = reference.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == reference.decode(ids, skip_special_tokens=False)


def test_edge_rows(spark):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(ODD)] + [(None, "a", "", 0)] * 2, SCHEMA)
    rows = B.decode_ids(B.encode_texts(df.repartition(3), PATH), PATH).collect()
    assert len(rows) == len(ODD) + 2
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {0}
    assert B.encode_texts(df.limit(0), PATH).count() == 0


def test_words_merged_side_by_side_equal_one_by_one():
    b = B.bpe(PATH)
    rng = random.Random(2)
    words = ["".join(rng.choices("aeinrst'-é", k=rng.choice([1, 2, 3, 7, 12, 39, 40, 41, 90]))) for _ in range(400)]
    words = ["".join(map(b.char_of.__getitem__, w.encode())) for w in words]
    symbols = [b.symbols(w + b.end) for w in words]
    flat, n = b.exact_many(np.array([i for s in symbols for i in s]), np.array([len(s) for s in symbols]))
    assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == [b.exact(s) for s in symbols] == b.encode_words(words)


def test_small_caches_change_nothing(monkeypatch, reference):
    monkeypatch.setattr(B, "KEPT_CHUNKS", 20)
    b = B.Bpe(PATH)
    texts = [f"word{i % 37} again and again {i * 31}" for i in range(200)]
    for at in range(0, 200, 10):
        for t, g in zip(texts[at:at + 10], b.encode(texts[at:at + 10]), strict=True):
            assert np.frombuffer(g, "<u4").tolist() == reference.encode(t, add_special_tokens=False).ids
    assert len(b.young) + len(b.old) < 150
