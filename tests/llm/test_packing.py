"""Every id in one piece, no gaps, little padding; ids as the tokenizers library gives them."""
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from txwatch.llm import packing as P
from txwatch.llm.queries import QUERIES
from txwatch.llm.tokens import encode

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, row int, length string"
ODD = [None, "", " ", "a", "\n\n  \t x", "<|endoftext|> and <|endoftext|>", "don't WE'LL 123   é ́ 日本語 🙂🙂 \x1c\x85",
       "same", "same", "word " * 9000, "z" * 5000]


def whole(rows, reference):
    """Rebuild every document and sequence from the pieces."""
    docs, packs = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length and 0 < r.length
        docs[r.doc_id].append(r)
        packs[r.sequence_id].append(r)
    for k, parts in docs.items():
        parts.sort(key=lambda r: r.start)
        assert b"".join(r.ids for r in parts) == np.array(reference[k], "<u4").tobytes()
        assert [r.start for r in parts] == [sum(x.length for x in parts[:i]) for i in range(len(parts))]
        assert {r.doc_tokens for r in parts} == {len(reference[k])}
    for parts in packs.values():
        parts.sort(key=lambda r: r.offset)
        at = 0
        for r in parts:
            assert r.offset == at
            at += r.length
        assert at <= P.SIZE
    assert set(packs) == set(range(len(packs)))
    return sum(map(len, reference.values())) / (P.SIZE * len(packs))


def test_pieces_rebuild_documents(spark):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(ODD)], SCHEMA).repartition(3)
    t = Tokenizer.from_file(PATH)
    ids = {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in enumerate(ODD)}
    whole(P.pack(df, PATH).collect(), ids)


def test_whole_table_has_little_padding(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    t = Tokenizer.from_file(PATH)
    ids = {r.doc_id: t.encode(r.text or "", add_special_tokens=False).ids + [1] for r in df.collect()}
    assert whole(P.pack(df, PATH).collect(), ids) > 0.97
    q = QUERIES["op10_packing"](spark, "/root/testdata/sf0.001")
    assert set(q.columns) >= {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    assert q.count() == P.pack(df, PATH).count()


def test_empty_table_and_repeated_rows(spark):
    assert P.pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0
    df = spark.createDataFrame([(7, "again", 1, "x")] * 3 + [(None, "x", 1, "")], SCHEMA)
    assert P.pack(df, PATH).where("doc_id = 7").count() == 3
    with pytest.raises(ValueError):
        P.pack(df, PATH, size=0)


@pytest.mark.parametrize("seed", range(20))
def test_patterns_place_every_length(seed):
    rng = random.Random(seed)
    size = rng.choice([8, 100, 2048])
    counts = {rng.randint(1, size - 1): rng.randint(1, 10 ** rng.randint(0, 6)) for _ in range(rng.randint(0, 300))}
    placed = defaultdict(int)
    for packs, runs in P.pack_histogram(counts, size):
        assert packs > 0 and sum(a * b for a, b in runs) <= size
        for length, times in runs:
            placed[length] += packs * times
    assert placed == counts
    assert len(P.slots(P.pack_histogram(counts, size), 0)) <= 8 * len(counts) + 1


def test_very_long_white_space():
    t = Tokenizer.from_file(PATH)
    texts = ["a" + " " * 3_000_000 + "b", "\n" * 3_000_000, "x " + " \n" * 1_500_000 + "<|endoftext|>" + " " * 20_000 + "\x1c y",
             "\u3000" * 12_000 + "z\x85" + "\t" * 10_000 + "'s", " " * 9_999 + "q"]
    for x in texts:
        assert encode(PATH, x).tolist() == t.encode(x, add_special_tokens=False).ids
