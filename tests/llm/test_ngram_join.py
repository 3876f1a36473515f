"""The join against all pairs of shingle sets, and edge rows."""
import random

from txwatch.llm import ngram_join as N
from txwatch.llm.components import components

SCHEMA = "doc_id long, text string, node string, row int"


def brute(rows, n=5, threshold=0.8):
    sets = []
    for _, text in rows:
        w = (text or "").encode().split()
        k = min(n, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    links = [set() for _ in rows]
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and both / (len(a) + len(sets[j]) - both) >= threshold:
                links[i].add(j)
                links[j].add(i)
    label = list(range(len(rows)))
    for start in range(len(rows)):
        if label[start] == start:
            todo = [start]
            while todo:
                for j in links[todo.pop()]:
                    if label[j] > start:
                        label[j] = start
                        todo.append(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[label[i]] = min(low.get(label[i], d), d)
    return sorted(((d, low.get(label[i]), len(links[i])) for i, (d, _) in enumerate(rows)), key=str)


def near(rng, base, edits):
    words = base[:]
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
    return words


def corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n", "one", "one two three", "one two  three", "one two three four five"]
    for size in (12, 60, 300):
        for _ in range(4):
            base = [f"w{rng.randrange(5000)}" for _ in range(size)]
            texts += [" ".join(near(rng, base, rng.randrange(0, max(2, size // 25)))) for _ in range(12)]
    texts.append(" ".join(f"long{i}" for i in range(30000)))
    return [(i, t) for i, t in enumerate(texts)] + [(3, "one"), (None, "one"), (None, None)]


def test_matches_brute_force_with_blocks_and_clashing_columns(spark):
    rows = corpus(1)
    df = spark.createDataFrame([(d, t, "n", 1) for d, t in rows], SCHEMA).repartition(5)
    for block in (3, N.BLOCK):
        got = N.ngram_join(df, recall=0.99999999, block=block).collect()
        assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute(rows)
    assert len(N.keep_one(df).collect()) == sum(r.leads for r in got)
    assert N.keep_one(df).columns == df.columns


def test_whole_table_matches_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = N.ngram_join(df).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute(rows)


def test_empty_table_and_banding(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert N.ngram_join(df).count() == 0 and N.keep_one(df).count() == 0
    bands, rows = N.banding()
    assert 1 - (1 - 0.8 ** rows) ** bands >= N.RECALL and bands * rows <= N.MAX_HASHES


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 90), (90, 95), (7, 7), (100, 90)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {95: 90, 100: 90}
