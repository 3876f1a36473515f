"""The index finds exactly the ids that were added, reading only candidate buckets."""
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from txwatch.operators import id_index as X
from txwatch.operators import standardize as ST


def frame(spark, ids):
    return spark.createDataFrame([(i, k, "x", "y") for k, i in enumerate(ids)], "transaction_id string, n int, _ string, id string").repartition(3)


def test_splits_as_the_joins_do(spark, tmp_path):
    rng = random.Random(1)
    index = X.IdIndex(spark, str(tmp_path / "index"))
    old = [f"id{rng.randint(0, 5000)}" for _ in range(1500)] + [None]
    more = [f"id{rng.randint(0, 5000)}" for _ in range(700)]
    new = [f"id{rng.randint(0, 9000)}" for _ in range(900)] + [None, None, ""]
    assert index.split(frame(spark, new), "transaction_id")[1].count() == 0  # nothing was added yet
    index.add(frame(spark, old), "transaction_id", per_bucket=100)
    index.add(frame(spark, more), "transaction_id", per_bucket=100)
    for _ in range(2):
        got = index.split(frame(spark, new), "transaction_id")
        want = ST.incremental_split(frame(spark, new), frame(spark, old + more))
        for g, w in zip(got, want):
            assert g.columns == w.columns and sorted(map(str, g.collect())) == sorted(map(str, w.collect()))
        index.compact()
    assert len(index.segments()) == 1 and index.compact() == index.segments()[0][0]


def test_only_candidate_buckets_are_read(spark, tmp_path):
    index = X.IdIndex(spark, str(tmp_path / "index"))
    segment = index.add(spark.range(20_000).select(F.col("id").cast("string").alias("transaction_id")), "transaction_id", per_bucket=200)
    (_, buckets), = index.segments()
    assert buckets == 100
    asked = frame(spark, ["17", "4711", "nowhere"])
    found = index.candidates(asked, "transaction_id", segment, buckets)
    wanted = sorted({r.bucket for r in found.collect()})
    assert 1 <= len(wanted) <= 3 and {r.id for r in found.collect()} >= {"17", "4711"}
    stored = index.stored(segment, wanted)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan
    files = stored.select(F.input_file_name().alias("f")).distinct().collect()
    assert {int(r.f.split("bucket=")[1].split("/")[0]) for r in files} == set(wanted)
    assert {r.id for r in index.seen(asked, "transaction_id").collect()} == {"17", "4711"}
    # ids that no filter knows open no file at all
    strange = spark.range(100).select(F.concat(F.lit("new"), "id").alias("transaction_id"))
    assert index.candidates(strange, "transaction_id", segment, buckets).count() <= 10


def test_a_failed_load_does_not_count(spark, tmp_path, monkeypatch):
    index = X.IdIndex(spark, str(tmp_path / "index"))
    index.add(frame(spark, ["a", "b"]), "transaction_id")
    monkeypatch.setattr(X, "bloom", None)  # the filters of the second load fail
    with pytest.raises(PySparkException):
        index.add(frame(spark, ["c"]), "transaction_id")
    monkeypatch.undo()
    assert len(index.segments()) == 1
    assert {r.transaction_id for r in index.split(frame(spark, ["a", "c"]), "transaction_id")[0].collect()} == {"c"}


def test_empty_loads(spark, tmp_path):
    index = X.IdIndex(spark, str(tmp_path / "index"))
    assert index.add(frame(spark, []), "transaction_id") is None and index.add(frame(spark, [None]), "transaction_id") is None
    assert index.segments() == [] and index.compact() is None
    index.add(frame(spark, ["a"]), "transaction_id")
    assert index.split(frame(spark, []), "transaction_id")[0].count() == 0


def test_filters_never_miss_and_seldom_err():
    rng = np.random.default_rng(2)
    h = rng.integers(-2**63, 2**63 - 1, (4, 20_000))
    data = X.bloom(h[0], h[1])
    assert X.may_hold(data, h[0], h[1]).all()
    assert X.may_hold(data, h[2], h[3]).mean() < 0.02
    assert 8 * len(data) <= X.BITS * 20_000 + 64
    assert X.may_hold(X.bloom(h[0, :1], h[1, :1]), h[0, :1], h[1, :1]).all()


def test_places_are_made_in_slices(monkeypatch):
    import numpy as np
    rng = np.random.default_rng(3)
    h1, h2 = (rng.integers(-2**63, 2**63 - 1, 1000) for _ in range(2))
    whole = X.bloom(h1, h2)
    sizes, places = [], X._places
    monkeypatch.setattr(X, "AT_ONCE", 64)
    monkeypatch.setattr(X, "_places", lambda a, b, n: sizes.append(len(a)) or places(a, b, n))
    assert X.bloom(h1, h2) == whole and X.may_hold(whole, h1, h2).all()
    assert max(sizes) == 64 and sum(sizes) == 2000


def test_a_load_larger_than_the_segment_asks_in_parts(spark, tmp_path):
    index = X.IdIndex(spark, str(tmp_path / "ix"))
    index.add(spark.createDataFrame([(f"i{k}",) for k in range(20)], "transaction_id string"), "transaction_id")
    asked = spark.createDataFrame([(f"i{k}",) for k in range(300)], "transaction_id string")
    (segment, buckets), = index.segments()
    found = {r.id for r in index.candidates(asked, "transaction_id", segment, buckets, per_bucket=50).collect()}
    assert {f"i{k}" for k in range(20)} <= found and len(found) < 60
    assert found == {r.id for r in index.candidates(asked, "transaction_id", segment, buckets).collect()}
