"""Each stage against a plain version of its decision, on a whole small table."""
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as C
from tests.llm.test_ngram_join import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}

    good = C.materialize(C.quality(spark, docs, SF), "t")
    before = {r.doc_id: r for r in docs.collect()}
    after = {r.doc_id: r for r in good.collect()}
    assert good.columns == names and all(before[k] == r for k, r in after.items())
    for k, r in before.items():  # no cutoff is certified on so few labels: the base alone
        w = r.text.encode().split()
        grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 5)} if len(w) < 800 else set()
        if len(w) < 800:
            assert (k in after) == (len(w) >= 10 and 100 * len(covered) <= 20 * len(w))
    assert sum(labels.get(k) == 1 for k in after) >= 0.9 * sum(v == 1 for v in labels.values())

    once = C.materialize(C.exact(spark, good, SF), "t")
    last = {}
    for k, r in after.items():
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text)
        last[t] = max(k, last.get(t, -1))
    after = {r.doc_id: r for r in once.collect()}
    assert once.columns == names and set(after) == set(last.values())

    one = C.materialize(C.near(spark, once, SF), "t")
    classes = brute([(k, r.text) for k, r in sorted(after.items())])
    assert {r.doc_id for r in one.collect()} == {c for _, c, _ in classes} and one.columns == names

    cut = C.materialize(C.passages(spark, one, SF), "t")
    rows = sorted(one.collect(), key=lambda r: r.doc_id)
    seen, expected = set(), {}
    for r in rows:
        w = r.text.encode().split()
        windows = [tuple(w[i:i + 13]) for i in range(len(w) - 12)]
        gone = {j for i, x in enumerate(windows) if x in seen for j in range(i, i + 13)}
        seen.update(windows)
        expected[r.doc_id] = b" ".join(x for i, x in enumerate(w) if i not in gone).decode() if gone else r.text
    assert {r.doc_id: r.text for r in cut.collect()} == expected and cut.columns == names

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    parts = {}
    for r in sorted(C.packed(spark, cut, SF).collect(), key=lambda r: (r.doc_id, r.start)):
        parts.setdefault(r.doc_id, []).append(r.ids)
    for k, text in expected.items():
        ids = t.encode(text, add_special_tokens=False).ids + [1]
        assert b"".join(parts[k]) == np.array(ids, "<u4").tobytes()


def test_run_is_the_stages_in_order(spark):
    assert [n for n, _ in C.STAGES] == ["quality_rules", "exact_dedup", "ngram_join", "substring_dedup", "packing"]
    assert C.run(spark, SF).count() > 0
