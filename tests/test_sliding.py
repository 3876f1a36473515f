"""Block-split trailing sums equal brute force for any block dividing the frame."""
import datetime as dt

import pytest

from tests.test_windows import brute, fixture_rows
from txwatch.operators.sliding import auto_block_seconds, sliding_sums


@pytest.mark.parametrize("block", [1, 60, 600, 1200, 3600])
@pytest.mark.parametrize("parts", [1, 8])
def test_sliding_sums_match_brute_force(spark, block, parts):
    rows = fixture_rows()
    df = spark.createDataFrame(rows, "id string, k string, ts timestamp_ntz, amount double").repartition(parts)
    got = sliding_sums(df, ["k"], "ts", [("n", 3600, None), ("s", 3600, "amount")], block,
                       totals=[("kn", None), ("ks", "amount")])
    res = {r.id: (r.n, r.s) for r in got.collect()}
    assert res == brute(rows, 3600)
    tot = {r.k: (r.kn, r.ks) for r in got.select("k", "kn", "ks").distinct().collect()}
    for k, (n, s) in tot.items():
        mine = [x for x in rows if x[1] == k]
        assert n == len(mine) and s == sum(x[3] for x in mine)


def test_two_frames_in_seconds(spark):
    rows = fixture_rows(300, seed=3)
    df = spark.createDataFrame(rows, "id string, k string, ts timestamp_ntz, amount double")
    got = sliding_sums(df, ["k"], "ts", [("a", 7200, None), ("b", 86400, None)], 3600,
                       time_unit_seconds=1)
    res = {r.id: (r.a, r.b) for r in got.collect()}

    def sec(t):
        return int((t - dt.datetime(1970, 1, 1)).total_seconds() // 1)
    for rid, k, t, _ in rows:
        a = sum(1 for x in rows if x[1] == k and sec(t) - 7200 <= sec(x[2]) <= sec(t))
        b = sum(1 for x in rows if x[1] == k and sec(t) - 86400 <= sec(x[2]) <= sec(t))
        assert res[rid] == (a, b)


def test_block_must_divide_frame(spark):
    df = spark.createDataFrame(fixture_rows(10), "id string, k string, ts timestamp_ntz, amount double")
    with pytest.raises(ValueError):
        sliding_sums(df, ["k"], "ts", [("n", 3600, None)], 7)


def test_auto_block(spark):
    df = spark.createDataFrame(fixture_rows(), "id string, k string, ts timestamp_ntz, amount double")
    assert auto_block_seconds(df, ["k"], "ts", 3600, target_rows=10 ** 9) == 3600
    small = auto_block_seconds(df, ["k"], "ts", 3600, target_rows=1)
    assert small < 3600 and 3600 % small == 0


def test_gold_same_for_any_block(spark):
    from tests.conftest import SF001
    from txwatch.operators import features as FE
    from txwatch.plans.pipeline import Ledger
    silver = Ledger(spark, SF001, persist=False).silver
    cols = ["transaction_id", "sender_tx_count_1h", "sender_amount_sum_1h", "sender_avg_amount", "rule_score"]
    ref = sorted(tuple(r) for r in FE.gold_features(silver, block_seconds=3600).select(*cols).collect())
    for block in (60, 900, None):
        got = sorted(tuple(r) for r in FE.gold_features(silver, block_seconds=block).select(*cols).collect())
        assert got == ref, block


@pytest.mark.parametrize("block", [60, 3600])
def test_cumulative_frame(spark, block):
    rows = fixture_rows(200, seed=11)
    df = spark.createDataFrame(rows, "id string, k string, ts timestamp_ntz, amount double")
    got = {r.id: (r.n, r.s) for r in sliding_sums(
        df, ["k"], "ts", [("n", None, None), ("s", None, "amount")], block).collect()}
    for rid, k, t, _ in rows:
        hits = [x for x in rows if x[1] == k and x[2] <= t]
        assert got[rid] == (len(hits), sum(x[3] for x in hits))


def test_gold_from_silver_without_its_derived_columns(spark):
    """Ids that are no digests survive, and the columns that are made anew are the same."""
    from pyspark.sql import functions as F
    from txwatch import schemas as S
    from txwatch.operators import features as FE
    from txwatch.operators import standardize as ST
    ids = ["0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "0123456789abcdef" * 2 + "\n", "t1", "", None]
    rows = [(i, dt.datetime(2022, 9, 3, 10, 7 * k), "s" if k % 2 else None, 10.5 * k) for k, i in enumerate(ids)]
    raw = spark.createDataFrame(rows, "transaction_id string, timestamp timestamp_ntz, sender_account_masked string, amount double")
    for c in S.SILVER_COLUMNS:
        if c not in raw.columns and c not in ST.DERIVED:
            raw = raw.withColumn(c, F.lit(1).cast("bigint") if c == "is_laundering" else F.lit("USD" if "currency" in c else "ACH"))
    silver = ST.with_derived(raw).select(*S.SILVER_COLUMNS)
    gold = FE.gold_features(silver, block_seconds=900)
    assert gold.columns == list(S.GOLD_COLUMNS)
    assert sorted(str(r.transaction_id) for r in gold.collect()) == sorted(map(str, ids))
    again = FE.gold_features(silver, block_seconds=900, derive=True)
    assert again.dtypes == gold.dtypes and sorted(map(str, again.collect())) == sorted(map(str, gold.collect()))


@pytest.mark.parametrize("block", [7200, 86400])
@pytest.mark.parametrize("derived", [False, True])
def test_blocks_longer_than_the_frame(spark, block, derived):
    """Only the end of a block is copied; rows without a time, nulls and whole-key sums are as ever."""
    from pyspark.sql import functions as F
    rows = fixture_rows(300, seed=5) + [("t1", "hot", None, 3.0), ("t2", "hot", None, None), ("t3", None, None, None),
                                        ("v1", "alone", dt.datetime(2022, 9, 1, 23, 59, 59), None), ("v2", None, dt.datetime(2022, 9, 2), 5.0)]
    df = spark.createDataFrame(rows, "id string, k string, ts timestamp_ntz, amount double")
    money = F.col("amount").cast("decimal(24,6)")
    frames, totals = [("n", 3600, None), ("s", 3600, "m"), ("all", None, "m")], [("ks", "m")]
    more = {"derive": {"m": money}, "needs": ["amount"]} if derived else {}
    rows_in = df if derived else df.withColumn("m", money)
    want = {r.id: r for r in sliding_sums(df.withColumn("m", money), ["k"], "ts", frames, 3600, totals=totals).collect()}
    got = {r.id: r for r in sliding_sums(rows_in, ["k"], "ts", frames, block, totals=totals, **more).collect()}
    assert len(want) == len(rows) and got.keys() == want.keys()
    for i, r in want.items():
        assert all(got[i][c] == r[c] for c in ("k", "ts", "amount", "n", "s", "all", "ks")), (i, r, got[i])
    with pytest.raises(ValueError):
        sliding_sums(df, ["k"], "ts", [("s", 3600, "amount")], block)


def test_auto_block_of_many_frames(spark):
    df = spark.createDataFrame(fixture_rows(), "id string, k string, ts timestamp_ntz, amount double")
    wide = (86400, 7200)
    assert auto_block_seconds(df, ["k"], "ts", 3600, wide=wide) == 86400
    busiest = max(r["count"] for r in df.selectExpr("k", "date(ts) as d").groupBy("k", "d").count().collect())
    assert auto_block_seconds(df, ["k"], "ts", 3600, target_rows=2 * busiest, wide=wide) == 86400
    assert auto_block_seconds(df, ["k"], "ts", 3600, target_rows=2 * busiest - 2, wide=wide) == 7200
    assert auto_block_seconds(df, ["k"], "ts", 3600, target_rows=1, wide=wide) < 3600
