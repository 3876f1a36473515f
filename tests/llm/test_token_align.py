"""Groups, links and counts equal a plain walk over the libraries' own tokens."""
import hashlib
import random
from collections import Counter, defaultdict
from functools import cache

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from txwatch.llm import token_align as T
from txwatch.llm.queries import QUERIES
from txwatch.llm.tokens import byte_of_char

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, chunk long, links string, `a.b` int"
ODD = [None, "", " ", "a", "x  y", " lead", "tail ", "\n\n  \t x \n", "<|endoftext|> and <s> </s> <unk> <0x41>", "don't WE'LL 123   é ́ 日本語 🙂🙂 \x1c\x85",
       "a▁b plain", "same words", "same words", "word " * 3000, "z" * 5000, "nul\x00 in it", "﻿bom", "　wide　 space  x", "́ mark",
       "a​b  c", "ﬁ ligature Å Å", " " * 12_000 + "x", "one \ntwo\n three", "\x1c \x1d x\x1f y"]


@cache
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def sides(text):
    a, b = libraries()
    table = byte_of_char()
    if not text:
        return [], []
    one = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    two = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        two.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    body = (" " + text).encode()
    if b"".join(x for _, x in one) != body or b"".join(x for _, x in two) != body:
        return [], []
    return one, two


def plain(texts):
    """``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each text."""
    known, counts, out = {}, Counter(), []
    for t in texts:
        if t not in known:
            one, two = sides(t)
            ends = []
            for side in (one, two):
                at, found = 0, []
                for _, x in side:
                    at += len(x)
                    found.append(at)
                ends.append(found)
            shared = sorted(set(ends[0]) & set(ends[1]))
            links = [(one[i][0], two[j][0]) for e in shared for i, x in enumerate(ends[0]) if x == e for j, y in enumerate(ends[1]) if y == e] \
                if len(one) < 200 else [(one[ends[0].index(e)][0], two[ends[1].index(e)][0]) for e in shared]
            groups, i, j = [], 0, 0
            for e in shared:
                k, m = ends[0].index(e, i) + 1, ends[1].index(e, j) + 1
                groups.append(",".join(str(x) for x, _ in one[i:k]) + "|" + ",".join(str(x) for x, _ in two[j:m]))
                i, j = k, m
            known[t] = len(one), len(two), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if one else ""
        counts.update(known[t][3])
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for t in texts:
        n_a, n_b, n_groups, links, digest = known[t]
        out.append((n_a, n_b, n_groups, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def found(df):
    return sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in T.cross_align(df, A, B).collect()), key=str)


def test_odd_texts(spark):
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in enumerate(ODD)], SCHEMA).repartition(3)
    assert found(df) == sorted(((i, *x) for i, x in enumerate(plain(ODD))), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_units_do_not_change_tokens(seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice([" ", " ", "  ", "\n", "\t", " ", "\x1c", "a", "the", "Ab", "é", "日", ",", "'s", "1", "…", "🙂", "<s>"])
                     for _ in range(rng.randint(1, 60))) for _ in range(150)]
    n_a, n_b, n_groups, n_links, groups, _ = T.align(T.vocabularies(A, B), [t.encode() for t in texts])
    for k, t in enumerate(texts):
        want = plain([t])[0]
        assert (n_a[k], n_b[k], n_groups[k], n_links[k], "" if groups[k] is None else hashlib.sha256(groups[k]).hexdigest()) == (*want[:4], want[6])


def test_small_slices_chunks_and_caches_change_nothing(spark, monkeypatch):
    pair = T.Pair(A, B)
    texts = [f"text number {i} has some words like {i * 7919}" for i in range(300)]
    monkeypatch.setattr(T, "KEPT", 100)
    whole = T.align(T.Pair(A, B), [t.encode() for t in texts])
    for at in range(0, 300, 30):
        part = T.align(pair, [t.encode() for t in texts[at:at + 30]])
        assert [bytes(g) for g in part[4]] == [bytes(g) for g in whole[4][at:at + 30]]
        assert len(pair.young) + len(pair.old) < 300


def test_not_utf8_has_no_tokens():
    n_a, n_b, *_ = T.align(T.vocabularies(A, B), [b"ok", b"\xff\xfe", b""])
    assert n_a.tolist() == [len(sides("ok")[0]), 0, 0] and n_b[1] == 0


def test_empty_table_repeats_and_null_ids(spark):
    assert T.cross_align(spark.createDataFrame([], SCHEMA), A, B).count() == 0
    rows = [(None, "again and again", 1, "x", 2)] * 3 + [(1, None, 1, "x", 2), (1, "", 1, "x", 2)]
    got = found(spark.createDataFrame(rows, SCHEMA).repartition(4))
    want = plain([r[1] for r in rows])
    assert got == sorted(((r[0], *x) for r, x in zip(rows, want)), key=str)


def test_registered_query_equals_the_libraries(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = QUERIES["op13_token_alignment"](spark, "/root/testdata/sf0.001").collect()
    want = plain([r.text for r in docs])
    assert sorted((r.doc_id, *(r[c] for c in COLUMNS)) for r in got) == sorted((r.doc_id, *x) for r, x in zip(docs, want))
