"""Shapley values equal the definition, summed over all coalitions, and add up to the raw score."""
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.conftest import SF001
from txwatch import schemas as S
from txwatch.operators import ml as ML
from txwatch.operators import shap as SH
from txwatch.plans.pipeline import Ledger


def expected(node, x, known):
    """The mean output of a tree if only ``known`` features of the row are known."""
    if node.getClass().getSimpleName() == "LeafNode":
        return node.prediction()
    f, cut = node.split().featureIndex(), node.split().threshold()
    left, right = node.leftChild(), node.rightChild()
    if f in known:
        return expected(left if x[f] <= cut else right, x, known)
    a, b = left.impurityStats().count(), right.impurityStats().count()
    return (a * expected(left, x, known) + b * expected(right, x, known)) / (a + b)


def definition(gbt, x, n):
    def game(known):
        return sum(w * expected(t._java_obj.rootNode(), x, known) for t, w in zip(gbt.trees, gbt.treeWeights))

    worth = {s: game(set(s)) for k in range(n + 1) for s in combinations(range(n), k)}
    out = []
    for f in range(n):
        others = [g for g in range(n) if g != f]
        out.append(sum(factorial(k) * factorial(n - k - 1) / factorial(n)
                       * (worth[tuple(sorted((*s, f)))] - worth[s]) for k in range(n) for s in combinations(others, k)))
    return np.array(out), worth[()]


@pytest.fixture(scope="module")
def small(spark):
    """A model over six features that repeat along its paths, with missing values."""
    names = ["a", "b", "c", "d", "e", "g"]
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 6)).round(1)
    y = (x[:, 0] * x[:, 1] + np.abs(x[:, 2]) > 0.5) | (x[:, 3] > 1.2)
    schema = "transaction_id string, " + ", ".join(f"{n} double" for n in names) + f", {S.TARGET} int, split string"

    def frame(x):
        return spark.createDataFrame([(str(i), *map(float, r), int(v), "train" if i % 3 else "val") for i, (r, v) in enumerate(zip(x, y))], schema)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(S, "FEATURES", tuple(names))
        model = ML.train(frame(x), max_iter=6)
    x[rng.random((600, 6)) < 0.03] = np.nan  # rows to explain may miss values
    return names, frame(x), model, x


def test_equals_the_definition(small):
    names, _, model, x = small
    gbt = model.stages[-1]
    assert max(t.depth for t in gbt.trees) == 6
    taken = SH.explainer(model, 6)
    values = taken.values(x[:12])
    for row, got in zip(x[:12], values):
        want, base = definition(gbt, row, 6)
        assert np.abs(want - got).max() < 1e-9 and abs(base - taken.base) < 1e-9


def test_values_add_up_to_the_raw_score(small):
    names, ds, model, x = small
    raw = {r.transaction_id: r.raw for r in model.transform(ds).select("transaction_id", vector_to_array("rawPrediction")[1].alias("raw")).collect()}
    rows = SH.shap_values(model, ds.repartition(5), names).collect()
    assert len(rows) == len(raw)
    for r in rows:
        assert abs(r.base + sum(r.shap) - raw[r.transaction_id]) < 1e-9


def test_means_over_all_rows_do_not_depend_on_the_layout(small):
    names, ds, model, _ = small
    values = np.array([r.shap for r in SH.shap_values(model, ds, names).collect()])
    for parts in (1, 7):
        got = {r.feature: (r.mean_abs_shap, r.mean_shap) for r in SH.shap_importance(model, ds.repartition(parts), names).collect()}
        for k, n in enumerate(names):
            assert abs(got[n][0] - np.abs(values[:, k]).mean()) < 1e-12 and abs(got[n][1] - values[:, k].mean()) < 1e-12
    order = [r.mean_abs_shap for r in SH.shap_importance(model, ds, names).collect()]
    assert order == sorted(order, reverse=True)
    assert SH.shap_importance(model, ds.limit(0), names).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_cases_of_one_leaf(seed):
    """A leaf's table against the definition, with ratios of 0 and 1 among them."""
    rng = np.random.default_rng(seed)
    m = int(rng.integers(1, 6))
    ratio = rng.random(m)
    ratio[0] = [0.0, 1.0, 0.5, 0.25][seed]
    table = SH.shares(2.5, ratio)
    for case in range(1 << m):
        inside = np.array([case >> k & 1 for k in range(m)])
        worth = lambda known: 2.5 * np.prod([inside[j] if j in known else ratio[j] for j in range(m)])
        for k in range(m):
            others = [j for j in range(m) if j != k]
            want = sum(factorial(s) * factorial(m - s - 1) / factorial(m) * (worth({*c, k}) - worth(set(c)))
                       for s in range(m) for c in combinations(others, s))
            assert abs(want - table[case, k]) < 1e-12


def test_gold_model(spark):
    ds = ML.ml_dataset(Ledger(spark, SF001, persist=False).gold)
    model = ML.train(ds, max_iter=5)
    raw = model.transform(ds).select("transaction_id", vector_to_array("rawPrediction")[1].alias("raw"))
    off = (SH.shap_values(model, ds).join(raw, "transaction_id")
           .agg(F.max(F.abs(F.col("base") + F.aggregate("shap", F.lit(0.0), lambda a, v: a + v) - F.col("raw"))).alias("off"),
                F.count(F.lit(1)).alias("n")).first())
    assert off.n == ds.count() and off.off < 1e-9
