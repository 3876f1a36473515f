"""Groups, ties and edge rows of exact dedup against a plain version."""
import hashlib
import random

from txwatch.llm import exact_dedup as E

SCHEMA = "doc_id long, text string, digest string, row int"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def check(spark, rows, counters):
    df = spark.createDataFrame([(*r, "d", 5) for r in rows], SCHEMA).repartition(6)
    got = E.exact_groups(df, counters=counters).collect()
    groups = {}
    for d, t in rows:
        groups.setdefault(lower(t), []).append(d)
    assert len(got) == len(rows)
    sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = [i for i in sha[r.text_sha256] if i is not None]
        assert r.group_size == len(sha[r.text_sha256]) and r.keep_id == max(ids, default=None)
        assert not r.kept or r.doc_id == r.keep_id
    assert sum(r.kept for r in got) == len(groups)
    kept = E.drop_copies(df, counters=counters)
    assert kept.columns == df.columns
    assert sorted(lower(r.text) for r in kept.collect()) == sorted(groups)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "Ä a"), (4, "Ä A"), (5, "ä a"), (6, "x" * 200000), (7, "X" * 200000), (8, "b"), (8, "b"), (8, "b"),
            (9, "c"), (9, "d"), (10, "c"), (None, "e"), (None, "e"), (None, None), (11, "E")]
    check(spark, rows, 16)


def test_hot_group_and_few_counters(spark):
    rng = random.Random(3)
    rows = [(i, "HOT" if rng.random() < 0.4 else f"t{rng.randrange(900)}") for i in range(3000)]
    check(spark, rows, 8)
    check(spark, rows, E.COUNTERS)
    found = E.frequent(spark.createDataFrame([(t,) for _, t in rows], "digest string"), 8)
    assert "HOT" in {r.digest for r in found.collect()} and found.count() <= 8


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert E.exact_groups(df).count() == 0 and E.drop_copies(df).count() == 0
