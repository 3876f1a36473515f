"""Ranks and percentiles equal a plain sort, whatever the column holds, in few passes."""
import math
import random
import struct

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txwatch.operators import alerts as A
from txwatch.operators import selection as S


def frame(spark, values):
    return spark.createDataFrame([(v, "x") for v in values], "s double, cell string").repartition(3)


def plain(values):
    kept = [v for v in values if v is not None]
    return sorted((v for v in kept if not math.isnan(v))) + [v for v in kept if math.isnan(v)]


def same(a, b):
    return a is None and b is None or a is not None and b is not None and (a == b or math.isnan(a) and math.isnan(b))


ODD = [None, 0.0, -0.0, 1e-300, 5e-324, -5e-324, 1e300, -1e300, 1.7e308, -1.7e308, math.inf, -math.inf, math.nan, 1.0, 1.0, 1.0, 0.1, 0.1 + 1e-17,
       1.0000000000000002, 2.0, -3.5]


@pytest.mark.parametrize("cells", [2, 3, 4096])
def test_odd_values(spark, cells):
    df = frame(spark, ODD)
    want = plain(ODD)
    ranks = list(range(-1, len(want) + 1))
    got = S.select_ranks(df, "s", ranks, cells)
    assert [same(g, want[r] if 0 <= r < len(want) else None) for r, g in zip(ranks, got)] == [True] * len(ranks)


def test_empty_null_and_single(spark):
    assert S.select_ranks(frame(spark, []), "s", [0]) == [None]
    assert S.percentile_exact(frame(spark, [None, None]), "s", 0.5) is None
    assert S.percentile_exact(frame(spark, [None, 4.5]), "s", 0.99) == 4.5
    with pytest.raises(ValueError):
        S.select_ranks(frame(spark, [1.0]), "s", [0], 1)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 2**64 - 1).map(lambda b: struct.unpack("<d", struct.pack("<Q", b))[0]), min_size=1, max_size=30), st.integers(2, 64))
def test_any_bits(spark, values, cells):
    want = plain(values)
    got = S.select_ranks(frame(spark, values), "s", [0, len(want) // 2, len(want) - 1], cells)
    assert all(same(g, w) for g, w in zip(got, [want[0], want[len(want) // 2], want[-1]]))


@pytest.mark.parametrize("share", [0.0, 0.5, 0.99, 0.9999, 1.0])
def test_equals_the_builtin_percentile(spark, share):
    rng = random.Random(4)
    for values in ([rng.random() for _ in range(3000)], [rng.choice([0.1, 0.25, 0.65]) for _ in range(500)], [10 ** rng.uniform(-30, 30) for _ in range(500)]):
        df = frame(spark, values)
        assert S.percentile_exact(df, "s", share) == df.agg(F.percentile("s", F.lit(share))).first()[0]


def test_a_dense_column_takes_few_passes(spark, monkeypatch):
    df = spark.range(200_000).select((F.abs(F.xxhash64("id")) / (2.0**63)).alias("s"))
    passes = []
    real = S.cell_of
    monkeypatch.setattr(S, "cell_of", lambda *a: passes.append(a) or real(*a))
    got = S.select_ranks(df, "s", [197_999, 198_000])
    want = [r.s for r in df.orderBy("s").collect()]
    assert got == want[197_999:198_001] and len(passes) <= 4


def test_no_task_gathers_the_scores(spark):
    gold = spark.range(1000).select((F.col("id") / 1000).alias("rule_score"), F.lit(1).alias("x"))
    plan = A.alert_threshold(gold)._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan.lower()
    assert A.alert_threshold(gold, 0.5).first().threshold == 0.4995
    assert A.alert_threshold(gold.limit(0)).first().threshold is None


def test_all_shares_come_from_the_same_passes(spark, monkeypatch):
    rng = random.Random(8)
    values = [rng.random() for _ in range(4000)]
    passes, cells = [], S.Values._cells
    monkeypatch.setattr(S.Values, "_cells", lambda self, spans, n: passes.append(len(spans)) or cells(self, spans, n))
    shares = [0.01, 0.5, 0.9, 0.99, 0.999]
    got = S.percentiles_exact(frame(spark, values), "s", shares, 64)
    df = frame(spark, values)
    assert got == [df.agg(F.percentile("s", F.lit(p))).first()[0] for p in shares]
    assert len(passes) <= 6 and max(passes) > 1
    assert S.percentiles_exact(frame(spark, [None]), "s", shares) == [None] * 5
