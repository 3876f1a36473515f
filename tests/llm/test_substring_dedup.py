"""Removed words against all windows, with any cover, batch and bucket size."""
import random
from itertools import product

import pytest

from txwatch.llm import substring_dedup as S

SCHEMA = "doc_id long, text string, kept_text string, batch int"


def brute(rows, window):
    key = lambda d: float("inf") if d is None else d
    low = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - window + 1):
            x = tuple(w[i:i + window])
            low[x] = min(low.get(x, float("inf")), key(d))
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = {j for i in range(len(w) - window + 1) if low[tuple(w[i:i + window])] < key(d) for j in range(i, i + window)}
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    passages = [[f"p{k}w{i}" for i in range(rng.randint(5, 40))] for k in range(6)]
    rows = []
    for d in range(60):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += rng.choice(passages)[rng.randint(0, 6):] if rng.random() < 0.6 else [f"u{rng.randrange(10 ** 6)}" for _ in range(rng.randint(1, 30))]
        rows.append((d, rng.choice([" ", "\n", " \t"]).join(w)))
    long = " ".join(f"w{i % 5000}" for i in range(20000))
    return rows + [(3, rows[20][1]), (None, rows[5][1]), (None, None), (70, None), (71, ""), (72, long), (73, long), (73, long),
                   (74, "a " * 50), (75, "a " * 12), (76, "a " * 13), (77, "nb\xa0sp\x85x \x1c" * 20), (78, "nb\xa0sp\x85x \x1c" * 20)]


@pytest.mark.parametrize("seed,window,period", [(1, 13, 7), (2, 13, 13), (3, 4, 3), (4, 1, 1)])
def test_matches_all_windows(spark, seed, window, period):
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA).repartition(4)
    for bytes_ in (S.BATCH_BYTES, 20000):
        got = S.substring_dedup(df, window=window, period=period, batch_bytes=bytes_, bucket_bytes=bytes_)
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()), key=str) == brute(rows, window)
    out = S.drop_repeats(df, window=window, period=period)
    assert out.columns == df.columns and out.count() == len(rows)


def test_empty_and_bad_period(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert S.substring_dedup(df).count() == 0 and S.drop_repeats(df).count() == 0
    with pytest.raises(ValueError):
        S.substring_dedup(df, window=5, period=6)


@pytest.mark.parametrize("period", range(1, 14))
def test_cover_reaches_every_pair_of_positions(period):
    cover = S.difference_cover(period)
    assert all(any((p + s) % period in cover and (q + s) % period in cover for s in range(period))
               for p, q in product(range(period), repeat=2))
