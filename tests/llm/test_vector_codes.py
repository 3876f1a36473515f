"""Codes, errors and codebooks equal a plain Lloyd iteration in Python integers."""
import random

import numpy as np
import pytest

from txwatch.llm import vector_codes as V
from txwatch.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, state string, vec string"


def plain(rows, parts=V.PARTS, entries=V.ENTRIES, rounds=V.ROUNDS):
    """``(id, label, code, error)`` sorted, and the books, by comparing everything with everything."""
    def floor(x):
        return max(-V.BOUND, min(V.BOUND, int(np.floor(np.float64(np.float32(x)) * V.SCALE))))

    kept = [(i, label, [floor(x) for x in v]) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max([parts, *(len(v) for _, _, v in kept)])
    width = -(-width // parts) * parts
    by_id = {}
    for i, _, v in kept:
        by_id[i] = min(by_id.get(i, v), v)
    ids = sorted(by_id, key=lambda i: (i is None, i or 0))[:entries]
    full = [[*v, *[0] * (width - len(v))] for _, _, v in kept]
    each = width // parts
    books = [[[*by_id[i], *[0] * (width - len(by_id[i]))][p * each:(p + 1) * each] for i in ids] for p in range(parts)]
    for turn in range(rounds + 1):
        near = [[min((sum((a - b) ** 2 for a, b in zip(v[p * each:(p + 1) * each], c)), e) for e, c in enumerate(books[p]))
                 for p in range(parts)] for v in full]
        if turn < rounds:
            for p in range(parts):
                for e in range(len(ids)):
                    mine = [v[p * each:(p + 1) * each] for v, n in zip(full, near) if n[p][1] == e]
                    if mine:
                        books[p][e] = [sum(col) // len(mine) for col in zip(*mine)]
    coded = [(i, label, bytes(e for _, e in n), sum(d for d, _ in n)) for (i, label, _), n in zip(kept, near)]
    return coded, books


def same(spark, rows, **how):
    df = spark.createDataFrame([(*r, "s", "v") for r in rows], SCHEMA).repartition(3)
    codes = V.fit(df, **how)
    want, books = plain(rows, **how)
    got = [(r.vec_id, r.label, bytes(r.code), r.error) for r in codes.frame.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert [b.tolist() for b in codes.codebooks] == books
    return codes


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_iteration(spark, seed):
    rng = random.Random(seed)
    spread = [1.0, 0.01, 300.0][seed]
    rows = [(i, [rng.gauss(0, spread) for _ in range(8)], rng.choice([None, 1, 2])) for i in range(150)]
    same(spark, rows, entries=[40, 3, 1][seed], rounds=[4, 6, 2][seed])


def test_nulls_ties_repeats_and_odd_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [1.0, None, 1.0, 1.0], 1), (3, [nan, 0.0, 0.0, 0.0], 1), (4, [inf, 0.0, 0.0, 0.0], 1),
            (None, [0.5, 0.5, 0.5, 0.5], None), (5, [0.0, 0.0, 0.0, 0.0], 1), (5, [0.0, 0.0, 0.0, 0.0], 1), (5, [0.001] * 4, 2),
            (6, [], None), (7, [0.25], 1), (8, [-0.0005, 1e30, -1e30, 2.0, 3.0], 2), (9, [0.25], 1),
            *((10 + i, [0.001 * (i % 3), 0.002, 0.001, 0.0], 3) for i in range(30))]
    same(spark, rows, entries=6)
    same(spark, [r for r in rows if r[0] is None])


def test_empty_table_and_label_sums(spark):
    codes = V.fit(spark.createDataFrame([], SCHEMA))
    assert codes.frame.count() == 0 and codes.codebooks == []
    rows = [(i, [0.1 * i, 0.0, 0.3, 0.0], None if i % 3 else i % 2) for i in range(20)]
    got = V.with_label_error(V.fit(spark.createDataFrame([(*r, "s", "v") for r in rows], SCHEMA), entries=2).frame).collect()
    for r in got:
        assert r.label_error == sum(x.error for x in got if x.label == r.label)
    assert len(got) == 20


@pytest.mark.parametrize("seed", range(8))
def test_bounds_never_hide_a_nearer_entry(seed):
    """Entries that move at will, lists of any length: the pass finds what a full comparison finds."""
    rng = np.random.default_rng(seed)
    k, d, b = int(rng.integers(1, 40)), int(rng.integers(1, 6)), int(rng.integers(0, 9))
    x = rng.integers(-20, 20, (500, d))
    book = rng.integers(-20, 20, (k, d))
    b = min(b, k - 1)
    state = V.search(x, book, b)
    for _ in range(6):
        new = book + rng.integers(-3, 4, (k, d)) * rng.integers(0, 2, (k, 1))
        step = V._up(np.sqrt(((new - book) ** 2).sum(1)))
        *state, used = V.update(x, new, step, *state)
        book = new
        d2 = V.squares(x, book)
        assert (state[0] == d2.argmin(1)).all()
        own = np.sqrt(d2[np.arange(500), state[0]])
        assert (state[1] >= own).all() and (used <= b + 1).all()
        other = d2.astype(float)
        np.put_along_axis(other, state[3], np.inf, 1)
        other[np.arange(500), state[0]] = np.inf
        assert (state[2] <= np.sqrt(other.min(1))).all()
        if b:
            assert (state[4] <= np.sqrt(np.take_along_axis(d2, state[3], 1))).all() and (np.diff(state[4], axis=1) >= 0).all()


def test_most_parts_are_settled_by_their_bounds():
    rng = np.random.default_rng(1)
    centre = rng.integers(-1000, 1000, (64, 16))
    x = centre[rng.integers(0, 64, 4000)] + rng.integers(-40, 40, (4000, 16))
    state = V.search(x, centre, 8)
    moved = centre + rng.integers(-4, 5, centre.shape)
    *state, used = V.update(x, moved, V._up(np.sqrt(((moved - centre) ** 2).sum(1))), *state)
    assert (used == 0).mean() > 0.9


def test_list_length_shrinks_to_what_settles():
    assert V.listed_next(np.array([900, 60, 30, 5, 3, 2, 0, 0, 0, 4]), 8) == 2
    assert V.listed_next(np.array([10, 0, 0, 0, 0, 0]), 4) == 2
    assert V.listed_next(np.array([0, 1, 1, 1, 97, 5]), 4) == 4
    assert V.listed_next(np.array([7, 3]), 0) == 0


def test_registered_query_decodes(spark):
    codes = V.fit(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"))
    kept = V.vectors(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"), "vec_id", "embedding", "label", V.SCALE)
    v = {r.vec_id: r.v for r in kept.collect()}
    for r in codes.frame.collect():
        assert ((codes.decode(bytes(r.code)) - np.array(v[r.vec_id])) ** 2).sum() == r.error
    q = QUERIES["op11_vector_codes"](spark, "/root/testdata/sf0.001")
    assert set(q.columns) >= {"vec_id", "code", "error", "label_error", "codebooks_sha256"} and q.count() == len(v)
