"""Time-split trailing windows equal the unsplit RANGE window (brute force),
for several bucket widths and partition counts, with a hot key, peers and
rows exactly one frame apart."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from txwatch.operators import features as FE
from txwatch.operators.windows import trailing_aggregates

T0 = dt.datetime(2022, 9, 1)


def fixture_rows(n=400, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 9)}"
        ts = T0 + dt.timedelta(seconds=rnd.randint(0, 3 * 86400))
        rows.append((f"id{i}", key, ts, float(rnd.randint(1, 500))))
    # peers (same key and time), exactly 3600 s apart, and 3600 s + 1 us apart
    rows += [("p1", "edge", T0, 1.0), ("p2", "edge", T0, 2.0),
             ("p3", "edge", T0 + dt.timedelta(seconds=3600), 4.0),
             ("p4", "edge", T0 + dt.timedelta(seconds=7200, microseconds=1), 8.0),
             ("p5", "edge", T0 + dt.timedelta(days=1), 16.0),
             ("p6", "edge", T0 + dt.timedelta(days=1, seconds=-1), 32.0)]
    return rows


def brute(rows, frame):
    out = {}
    for rid, k, t, a in rows:
        hits = [x for x in rows if x[1] == k and t - dt.timedelta(seconds=frame) <= x[2] <= t]
        out[rid] = (len(hits), sum(x[3] for x in hits))
    return out


@pytest.mark.parametrize("bucket", [None, 600, 3600, 86400])
@pytest.mark.parametrize("parts", [1, 8])
def test_trailing_matches_brute_force(spark, bucket, parts):
    rows = fixture_rows()
    df = spark.createDataFrame(rows, "id string, k string, ts timestamp_ntz, amount double").repartition(parts)
    got = trailing_aggregates(
        df, ["k"], "ts",
        [("n", 3600, lambda: F.count(F.lit(1))), ("s", 3600, lambda: F.sum("amount"))],
        value_cols=["amount"], bucket_seconds=bucket)
    res = {r.id: (r.n, r.s) for r in got.collect()}
    assert res == brute(rows, 3600)


def test_seconds_frames_truncate(spark):
    rows = [("a", "k", T0 + dt.timedelta(microseconds=900000), 1.0),
            ("b", "k", T0 + dt.timedelta(days=7, microseconds=100), 1.0),
            ("c", "k", T0 + dt.timedelta(days=7, seconds=1), 1.0)]
    df = spark.createDataFrame(rows, "transaction_id string, sender_account_masked string, "
                                     "timestamp timestamp_ntz, amount double")
    got = {r.transaction_id: (r.rolling_7d_tx_count, r.rolling_30d_tx_count)
           for r in FE.long_window_features(df).collect()}
    # unix seconds: a=0, b=604800 (a inside 7d), c=604801 (a outside 7d)
    assert got == {"a": (1, 1), "b": (2, 2), "c": (2, 3)}


def test_zscore_constant_and_single(spark):
    rows = [("1", "A", 5.0), ("2", "A", 5.0), ("3", "B", 7.0), ("4", "C", 1.0), ("5", "C", 3.0)]
    df = spark.createDataFrame(rows, "transaction_id string, payment_type string, amount double")
    got = {r.transaction_id: r.amount_zscore for r in FE.amount_zscore(df).collect()}
    assert got["1"] == 0.0 and got["3"] == 0.0
    assert abs(got["4"] + 0.7071067811865475) < 1e-12 and abs(got["5"] - 0.7071067811865475) < 1e-12


def test_shuffles_have_partitions_for_the_rows(spark):
    from txwatch.session import shuffles_for
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with shuffles_for(spark, 1001, 100):
        assert int(spark.conf.get(name)) == max(11, int(before))
    with shuffles_for(spark, 10, 100):
        assert spark.conf.get(name) == before
    assert spark.conf.get(name) == before
