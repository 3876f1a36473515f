"""Measures against plain counts, certified cutoffs against exact binomial sums."""
import random
import re
from collections import Counter
from math import comb

from pyspark.sql import functions as F

from txwatch.llm import quality_rules as Q

SCHEMA = "doc_id long, text string, lang string, stratum string, cut_symbols int, n_words int"


def plain(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(grams)
    rep = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 5)}
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep)]


def test_measures_and_edges(spark):
    rng = random.Random(1)
    texts = [None, "", " \n \x0b", "one", "a b c d e", "a b c d e a b c d e", "a a a a a a", "l\nl\n\nl \n l", "#*$ %&|<> é🙂 x\xa0y",
             " ".join(rng.choice("abc") for _ in range(300)), "the same line here\n" * 50, " ".join(f"w{i}" for i in range(30000)),
             " ".join(f"w{i % 700}" for i in range(5000)), "a b c d e x a b c d e y b c d e x"]
    rows = [(i, t, None if i % 3 else "xx", "s", 1, 2) for i, t in enumerate(texts)] + [(5, texts[5], "xx", "s", 1, 2), (None, "b", "q", "", 0, 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    got = Q.quality_rules(df, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            want = plain(texts[r.doc_id])
            assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == want, texts[r.doc_id]
            assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and r.kept == (not r.base_failed)
    kept = Q.keep_good(df, labels)
    assert kept.columns == df.columns and kept.count() == sum(r.kept for r in got)
    empty = df.limit(0)
    assert Q.quality_rules(empty, labels).count() == 0 and Q.keep_good(empty, labels.limit(0)).count() == 0


def test_binomial_is_exact(spark):
    cases = [(k, n, p) for n in (1, 7, 60, 900) for p in (0.004, 0.02, 0.3) for k in (0, 1, 2, 5) if k < n * p]
    df = spark.createDataFrame(cases, "k long, n long, p double")
    for r in df.withColumn("x", Q.binomial_cdf(F.col("k"), F.col("n"), F.col("p"))).collect():
        want = sum(comb(r.n, i) * r.p ** i * (1 - r.p) ** (r.n - i) for i in range(r.k + 1))
        assert abs(r.x - want) < 1e-9


def test_cutoffs_limit_false_rejections_and_reject_junk(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(6000):
        lang, junk = rng.choice("ab"), rng.random() < 0.2
        w = [f"w{rng.randrange(10 ** 6)}" for _ in range(40)]
        if junk:
            w = [x + "$$" for x in w]
        elif lang == "b" and rng.random() < 0.3:
            w = [x + "#" if rng.random() < 0.3 else x for x in w]  # clean texts of this stratum use symbols
        rows.append((i, " ".join(w), lang))
        if rng.random() < 0.9:
            labels.append((i, 0 if junk else 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in Q.quality_rules(df, lab).collect()}
    for lang in "ab":
        good = [i for i, q in labels if q == 1 and rows[i][2] == lang]
        assert sum(not got[i] for i in good) <= Q.ALPHA * len(good)
    assert not any(got[i] for i, q in labels if q == 0)
    few = spark.createDataFrame(labels[:100], "doc_id long, quality int")
    assert all(r.kept for r in Q.quality_rules(df, few).collect())  # too few labels certify nothing
