"""Metrics against brute force on small fixtures (ties included)."""
import random

import pytest

from txwatch.operators import metrics as M
from txwatch.operators import ml as ML


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "score double, label int")


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y != 1]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def brute_ap(pairs):
    # sum over distinct thresholds (descending) of (R_n - R_n-1) * P_n
    P = sum(1 for _, y in pairs if y == 1)
    ap, prev_r = 0.0, 0.0
    for t in sorted({s for s, _ in pairs}, reverse=True):
        tp = sum(1 for s, y in pairs if s >= t and y == 1)
        fp = sum(1 for s, y in pairs if s >= t and y != 1)
        r = tp / P
        ap += (r - prev_r) * (tp / (tp + fp))
        prev_r = r
    return ap


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_and_ap(spark, seed):
    rnd = random.Random(seed)
    pairs = [(round(rnd.random(), 2), int(rnd.random() < 0.3)) for _ in range(300)]
    pairs += [(0.0, 1), (1.0, 0), (1.0, 1)]
    df = frame(spark, pairs)
    assert abs(M.auc_roc(df).first().auc_roc - brute_auc(pairs)) < 1e-12
    assert abs(M.average_precision(df).first().auc_pr - brute_ap(pairs)) < 1e-9


def test_auc_single_class_is_null(spark):
    assert M.auc_roc(frame(spark, [(0.1, 0), (0.2, 0)])).first().auc_roc is None


def test_sweep_and_best(spark):
    pairs = [(0.95, 1), (0.85, 1), (0.85, 0), (0.40, 0), (0.30, 1), (0.02, 0)]
    sw = {r.threshold: r for r in M.threshold_sweep(frame(spark, pairs)).collect()}
    assert len(sw) == 18 and min(sw) == 0.05 and max(sw) == 0.9
    r = sw[0.85]
    assert (r.predicted_pos, r.tp, r.fp, r.fn) == (3, 2, 1, 1)
    assert abs(r.f1 - 2 * 2 / (2 * 2 + 1 + 1)) < 1e-15
    best = M.best_threshold(M.threshold_sweep(frame(spark, pairs))).first()
    f1s = {t: x.f1 for t, x in sw.items() if x.predicted_pos > 0}
    top = max(f1s.values())
    assert best.threshold == min(t for t, f in f1s.items() if f == top)


def test_best_threshold_default_when_nothing_scores(spark):
    pairs = [(0.01, 1), (0.02, 0)]
    best = M.best_threshold(M.threshold_sweep(frame(spark, pairs))).first()
    assert (best.threshold, best.f1) == (0.5, 0.0)


def test_confusion_report(spark):
    pairs = [(0.9, 1), (0.9, 0), (0.1, 1), (0.1, 0), (0.1, 0)]
    cm = M.confusion(frame(spark, pairs), 0.5)
    row = M.from_confusion(cm).first()
    assert (row.tn, row.fp, row.fn, row.tp) == (2, 1, 1, 1)
    assert (row.precision, row.recall) == (0.5, 0.5)
    rep = {r["class"]: r for r in M.classification_report(cm).collect()}
    assert rep["accuracy"].f1 == 0.6 and rep["1"].support == 2 and rep["0"].support == 3


def test_class_balance_no_positives(spark):
    import datetime as dt
    rows = [(dt.datetime(2022, 9, 2), 0), (dt.datetime(2022, 9, 3), 0)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, is_laundering long")
    ds = df.withColumn("split", ML.split_label())
    assert ML.class_balance(ds).first().scale_pos_weight == 1000.0


def test_both_areas_group_the_rows_once(spark, monkeypatch):
    pairs = [(i % 37 / 37, int(i % 5 == 0)) for i in range(400)]
    written, keep = [], M.materialize
    monkeypatch.setattr(M, "materialize", lambda df, *a, **k: written.append(keep(df, *a, **k)) or written[-1])
    row = M.areas(frame(spark, pairs)).first()
    assert abs(row.auc_roc - brute_auc(pairs)) < 1e-12 and abs(row.auc_pr - brute_ap(pairs)) < 1e-9
    assert len(written) == 1 and written[0].count() == 37
