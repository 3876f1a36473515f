"""Gradients, normalisation, whole-document scores and the base against plain versions."""
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from txwatch.llm import gru as G
from txwatch.llm import lm_score as L

SCHEMA = "doc_id long, text string, n_tokens string, score int"


def model(k=11, hidden=5, seed=3):
    p = G.init(np.arange(k, dtype=float), hidden, seed)
    rng = np.random.default_rng(seed)
    for name in p:
        p[name] = (p[name] + rng.normal(0, 0.3, p[name].shape)).astype(np.float32)
    return p


def test_gradient():
    p, rng = model(), np.random.default_rng(0)
    given, token = rng.integers(0, 11, (6, 4)), rng.integers(0, 11, (6, 4))
    fresh, live = rng.random((6, 4)) < 0.2, np.ones((6, 4), bool)
    live[4:, 3] = False
    h = rng.normal(0, 0.5, (4, 5)).astype(np.float32)
    _, g, _ = G.window_gradient(p, given, token, fresh, live, h)
    for k in p:
        step = rng.normal(0, 1, p[k].shape).astype(np.float32)
        step /= np.linalg.norm(step)
        ends = [G.window_gradient(p | {k: p[k] + np.float32(e) * step}, given, token, fresh, live, h)[0] for e in (2e-2, -2e-2)]
        assert math.isclose((ends[0] - ends[1]) / 4e-2, float((g[k] * step).sum()), rel_tol=3e-2, abs_tol=3e-2), k


def test_distribution_sums_to_one():
    p = model()
    states = np.random.default_rng(1).normal(0, 1, (1, 5)).astype(np.float32)
    n = p["word_b"].size
    logp, _ = G.output(p, np.repeat(states, n, 0), np.arange(n))
    assert math.isclose(np.exp(logp).sum(), 1, rel_tol=1e-4)


def test_lanes_do_not_change_scores():
    p, rng = model(), np.random.default_rng(2)
    docs = [rng.integers(0, 11, n).astype(np.int32) for n in (1, 200, 3, 50, 1, 77, 8)]
    alone = np.array([G.score(p, [d], 1, 1, 1000)[0] for d in docs])
    for width, window in ((1, 7), (3, 32), (512, 5)):
        assert np.allclose(G.score(p, docs, 1, width, window), alone, rtol=1e-4)
    assert len(G.score(p, [], 1)) == 0


def test_training_learns_an_order_that_counts_cannot():
    docs = [np.array([2, 3, 4, 5] * 30 + [1], np.int32) for _ in range(64)]
    mass = np.array([0, 64, *[1920] * 4], float)
    p = G.init(mass, 12)
    before = G.score(p, docs[:2], 1)
    adam = G.Adam(p, 0.02)
    for _ in range(12):
        G.train(p, docs, 1, adam, 16, 8)
    assert (G.score(p, docs[:2], 1) > 0.5 * before).all()


def plain(rows):
    out = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    cut = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split() + [b""]
    counts = Counter()
    for d, t in rows:
        if not out(d):
            counts.update(cut(t))
    n, v = sum(counts.values()), len(counts)
    return [(d, out(d), len(w := cut(t)), sum(counts[x] > 0 for x in w), n,
             sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for d, t in rows]


def same(df, rows, **options):
    got = L.scores(df, **options).collect()
    key = lambda r: tuple(str(x) for x in r[:5])
    for g, w in zip(sorted(got, key=key), sorted(plain(rows), key=key), strict=True):
        assert tuple(g)[:5] == w[:5] and math.isclose(g.base_score, w[5], rel_tol=1e-9)
        assert g.score < 0 or g.train_tokens == 0
    return got


def test_edge_rows(spark):
    rows = [(i, t) for i, t in enumerate([None, "", "a A b", "rare É é", "x " * 3000, "a\x0bb\x1cc", "same", "same"] * 3)]
    rows += [(None, "a b"), (6, "same"), (6, "same"), (99, "never seen words")]
    df = spark.createDataFrame([(*r, "n", 1) for r in rows], SCHEMA).repartition(3)
    same(df, rows, vocabulary=8, batch_bytes=500)
    assert L.scores(df.limit(0)).count() == 0
    held = [r for r in rows if r[0] is None]
    none = L.scores(spark.createDataFrame([(*r, "n", 1) for r in held], SCHEMA)).collect()
    assert none[0].train_tokens == 0 and none[0].base_score == 0.0


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_whole_table_and_held_out_accuracy(spark, table):
    got = same(table, [(r.doc_id, r.text) for r in table.collect()], share=1.0)
    new = [r for r in got if r.held_out]
    assert sum(r.score for r in new) > sum(r.base_score for r in new)


def test_registered_settings_train_on_every_document_once(spark, table, monkeypatch):
    written, keep = [], L.materialize

    def note(df, name):
        out = keep(df, name)
        if name == "models":
            written.append(out)
        return out

    monkeypatch.setattr(L, "materialize", note)
    got = L.scores(table).collect()
    assert sum(r.weight for m in written for r in m.select("weight").collect()) == got[0].train_tokens
    new = [r for r in got if r.held_out]
    assert sum(r.score for r in new) > sum(r.base_score for r in new)
