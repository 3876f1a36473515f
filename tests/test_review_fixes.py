"""Scores with many values, null keys, one-month layers, promotion, failed runs, shared folder."""
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from txwatch.operators import alerts as A
from txwatch.operators import ingest as I
from txwatch.operators import metrics as M
from txwatch.operators import sliding as SL
from txwatch.operators import standardize as ST
from txwatch.plans import jobs
from txwatch.plans import publish as P
from txwatch.sources import testdata as TD


def test_auc_and_ap_of_many_distinct_scores(spark):
    n = 600_000
    df = spark.range(n, numPartitions=8).select(
        (F.pmod(F.xxhash64("id"), F.lit(1 << 50)) / (1 << 50)).alias("u"), (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(10)) == 0).cast("int").alias("label"))
    df = df.select((F.col("u") * F.col("u") + F.col("label") * 0.1).alias("score"), "label").repartition(8)
    pdf = df.toPandas().sort_values("score")
    rank, pos = pdf.score.rank(method="average").to_numpy(), pdf.label.to_numpy() == 1
    p, q = pos.sum(), (~pos).sum()
    auc = (rank[pos].sum() - p * (p + 1) / 2) / (p * q)
    down = pos[::-1]
    ap = (np.cumsum(down) / np.arange(1, n + 1))[down].sum() / p
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        for _ in range(2):
            assert abs(M.auc_roc(df).first()[0] - auc) < 1e-9
            assert abs(M.average_precision(df).first()[0] - ap) < 1e-7
    spark.conf.unset("spark.sql.exchange.reuse")


def test_bucket_of_counts_the_bounds_below(spark):
    bounds = [0.0, 0.25, 0.5, 2.0]
    rows = [(x,) for x in (-1.0, 0.0, 0.1, 0.25, 0.3, 0.5, 1.0, 2.0, 9.0)]
    got = spark.createDataFrame(rows, "s double").select("s", M.bucket_of(F.col("s"), bounds).alias("b")).collect()
    assert all(r.b == sum(x <= r.s for x in bounds) for r in got)


def test_windows_group_null_keys_and_times(spark):
    rows = [(None, "2022-09-01 00:00:00", 1.0), (None, "2022-09-01 00:30:00", 2.0), ("a", "2022-09-01 00:10:00", 4.0),
            ("a", None, 8.0), ("a", None, 16.0), (None, None, 32.0)]
    df = spark.createDataFrame(rows, "k string, t string, v double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    df = df.withColumn("v", F.col("v").cast("decimal(24,6)"))
    got = SL.sliding_sums(df, ["k"], "t", [("n", 3600, None), ("s", 3600, "v")], 600, totals=[("all", "v")])
    out = sorted((str(r.k), str(r.t), r.n, float(r.s), float(r["all"])) for r in got.collect())
    assert out == sorted([("None", "2022-09-01 00:00:00", 1, 1.0, 35.0), ("None", "2022-09-01 00:30:00", 2, 3.0, 35.0),
                          ("a", "2022-09-01 00:10:00", 1, 4.0, 28.0), ("a", "None", 2, 24.0, 28.0), ("a", "None", 2, 24.0, 28.0),
                          ("None", "None", 1, 32.0, 35.0)])


def test_dedup_returns_every_row(spark):
    rows = [("x", 0, 0), ("x", 0, 1), ("x", 1, 0), (None, 0, 2), (None, 0, 3), ("y", None, 4)]
    got = ST.mark_duplicates(spark.createDataFrame(rows, "transaction_id string, chunk_id int, r int"), order_cols=["r"])
    assert sorted(str(r.dead_reason) for r in got.collect()) == sorted(
        ["None", "intra_chunk_duplicate", "inter_chunk_duplicate", "None", "None", "unknown_chunk"])


def test_dead_letter_reasons(spark):
    raw = TD.ledger_bronze(spark, SF001)
    clean, dead = I.split_dead_letter(raw)
    assert clean.count() + dead.count() == raw.count()
    reasons = {r[0] for r in dead.select(I.dead_letter_reason()).distinct().collect()}
    assert reasons == {"missing_amount", "negative_amount", "missing_account", "bad_timestamp"}


def test_cut_is_not_rounded(spark):
    gold = spark.createDataFrame([(0.1234561,)] * 99 + [(0.1234564,)], "rule_score double")
    exact = A.alert_threshold(gold, 0.995, None).first()[0]
    assert 0.1234561 < exact < 0.1234564 and A.alert_threshold(gold, 0.995).first()[0] == 0.123456
    assert gold.where(F.col("rule_score") >= A.threshold_value(gold, 0.995)).count() == 1


def test_one_month_is_written_by_many_tasks(spark):
    root = tempfile.mkdtemp(prefix="txw-month-")
    df = spark.range(400_000, numPartitions=4).select(F.lit("2022").alias("year"), F.lit("09").alias("month"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    P.write_layer(df, f"{root}/m", ("year", "month"))
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(f"{root}/m/year=2022/month=09") if f.endswith(".parquet")]
    assert len(files) >= 4 and spark.read.parquet(f"{root}/m").count() == 400_000


def test_promotion_never_loses_the_layer(spark):
    root = tempfile.mkdtemp(prefix="txw-move-")
    spark.range(3).write.parquet(f"{root}/target")
    spark.range(5).write.parquet(f"{root}/stage")
    P._move(spark, f"{root}/stage", f"{root}/target")
    assert spark.read.parquet(f"{root}/target").count() == 5
    P._move(spark, f"{root}/stage", f"{root}/target")  # already done
    os.rename(f"{root}/target", f"{root}/target._old")  # a crash between the two renames, and the stage lost
    P._move(spark, f"{root}/stage", f"{root}/target")
    assert spark.read.parquet(f"{root}/target").count() == 5
    with pytest.raises(FileNotFoundError):
        P._move(spark, f"{root}/no", f"{root}/none")


def test_failed_run_is_audited(spark):
    root = tempfile.mkdtemp(prefix="txw-fail-")
    with pytest.raises(ValueError):
        jobs.run_pipeline(spark, TD.ledger_bronze(spark, SF001), root, "r", TD.DEFAULT_RUN_TS, min_rows=10 ** 9)
    rows = {(r.layer, r.status) for r in spark.read.parquet(f"{root}/audit").collect()}
    assert rows == {("bronze", "success"), ("silver", "failed")}
    assert not os.path.exists(f"{root}/silver") and not os.path.exists(f"{root}/silver_dead")


def test_late_events_find_what_they_need(spark, tmp_path):
    """An event that is late, but within the watermark, counts events that are
    older than one frame behind the newest."""
    import datetime as dt

    import pyarrow as pa
    import pyarrow.parquet as pq

    from txwatch.streaming import streams as SS
    at = lambda h, m: dt.datetime(2022, 9, 1, h, m)
    files = [[(1, at(10, 0)), (2, at(10, 50))], [(3, at(11, 30))], [(4, at(10, 45))]]
    for i, rows in enumerate(files):
        pq.write_table(pa.table({"event_id": [r[0] for r in rows], "ts": pa.array([r[1] for r in rows], pa.timestamp("us")), "user_id": [7] * len(rows),
                                 "event_type": ["x"] * len(rows), "value": [1.005] * len(rows), "props": [""] * len(rows)}), tmp_path / f"events_{i}.parquet")
        os.utime(tmp_path / f"events_{i}.parquet", (1_600_000_000 + i, 1_600_000_000 + i))
    got = {str(r.timestamp)[11:16]: (r.sender_tx_count_1h, r.sender_amount_sum_1h)
           for r in SS.stream_trailing_velocity(spark, str(tmp_path), max_files=1).collect()}
    assert got["10:45"] == (2, 2.01) and got["10:50"][0] == 2 and got["11:30"][0] == 2


def test_bronze_gate_sees_single_files(spark):
    from txwatch.operators import quality as Q
    root = tempfile.mkdtemp(prefix="txw-gate-")
    raw = TD.ledger_bronze(spark, SF001).select(*jobs.RAW_COLUMNS).limit(50)
    P.write_bronze(raw, f"{root}/b")
    assert all(r.passed for r in Q.gate_bronze_files(spark, f"{root}/b").collect())
    raw.drop("Amount Paid").coalesce(1).write.parquet(f"{root}/b/year=2022/month=10")
    failed = [r for r in Q.gate_bronze_files(spark, f"{root}/b").collect() if not r.passed]
    assert [(r.rule, r.violations) for r in failed] == [("files_without_amount_paid", 1)]
