"""Threshold, alert cut with ties, and the status change log."""
import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from txwatch.operators import alerts as A

T = dt.datetime(2022, 9, 18)


def gold(spark, scores):
    rows = [(f"t{i}", s, 0, 0, 0, 1, 0.0, 100.0) for i, s in enumerate(scores)]
    return spark.createDataFrame(rows, "transaction_id string, rule_score double, is_structuring long, "
                                       "is_high_risk_type long, is_cross_currency long, "
                                       "sender_tx_count_1h long, amount_vs_sender_avg double, amount double"
                                 ).withColumn("is_round_amount", F.lit(0))


def test_threshold_is_exact_percentile(spark):
    scores = [0.1] * 50 + [0.2] * 30 + [0.5] * 15 + [0.9] * 5
    thr = A.alert_threshold(gold(spark, scores)).first().threshold
    assert thr == round(float(np.percentile(scores, 99)), 6)


def test_alerts_keep_ties(spark):
    scores = [0.1] * 90 + [0.9] * 10
    alerts = A.generate_alerts(gold(spark, scores), "2022-09-18T00:00:00")
    assert alerts.count() == 10   # p99 = 0.9, every tie is in


def test_status_log(spark):
    alerts = spark.createDataFrame(
        [("a1", "OPEN", T, None), ("a2", "OPEN", T, None), ("a3", "OPEN", T, None)],
        "alert_id string, status string, created_at timestamp_ntz, updated_at timestamp_ntz")
    changes = spark.createDataFrame([
        ("a1", "investigating", T + dt.timedelta(hours=1)),
        ("a1", "closed", T + dt.timedelta(hours=2)),
        ("a2", "bogus", T + dt.timedelta(hours=1)),
        ("zz", "CLOSED", T + dt.timedelta(hours=1)),
    ], "alert_id string, status string, changed_at timestamp_ntz")
    cur, rej = A.apply_status_changes(alerts, changes)
    got = {r.alert_id: (r.status, r.updated_at) for r in cur.collect()}
    assert got == {"a1": ("CLOSED", T + dt.timedelta(hours=2)), "a2": ("OPEN", None), "a3": ("OPEN", None)}
    assert sorted((r.alert_id, r.reason) for r in rej.collect()) == [
        ("a2", "invalid_status"), ("zz", "alert_not_found")]


def test_detail_moves_only_rows_that_an_alert_meets(spark):
    from pyspark.sql import functions as F
    from txwatch.operators import analytics as AN
    from txwatch.operators.standardize import only_ids_of
    gold = spark.range(5000).select(
        F.when(F.col("id") % 1000 != 999, F.concat(F.lit("t"), (F.col("id") % 4000).cast("string"))).alias("transaction_id"), F.col("id").cast("double").alias("amount"),
        F.lit("ACH").alias("payment_type"), F.lit("a").alias("sender_account_masked"), F.lit("b").alias("receiver_account_masked"),
        F.lit("2022-09-01 00:00:00").cast("timestamp_ntz").alias("timestamp"), F.lit(0).cast("bigint").alias("is_laundering"), F.lit(0.5).alias("rule_score"))
    scores = gold.select("transaction_id", F.lit(0.9).alias("ml_probability"), F.lit(0.9).alias("final_risk_score")).where(F.col("transaction_id") != "t7")
    alerts = spark.createDataFrame([("x1", "t5"), ("x2", "t7"), ("x3", None), ("x4", "none"), ("x5", "t3000")], "alert_id string, transaction_id string")
    alerts = alerts.withColumns({"risk_score": F.lit(0.5), "typology": F.lit("p"), "status": F.lit("OPEN"), "created_at": F.lit("2022-09-18 00:00:00").cast("timestamp_ntz")})
    assert only_ids_of(gold, alerts).count() == 5  # t5 and t7 come twice
    assert only_ids_of(gold, alerts.limit(0)).count() == 0 and only_ids_of(gold, alerts, places=1).count() == 4995
    got = sorted((r.alert_id, r.amount, r.ml_probability, r.risk_level) for r in AN.alert_detail(alerts, gold, scores).collect() if r.amount is not None)
    assert got == [("x1", 5.0, 0.9, "CRITICAL")] * 2 + [("x1", 4005.0, 0.9, "CRITICAL")] * 2 + [("x2", 7.0, None, "UNKNOWN"), ("x2", 4007.0, None, "UNKNOWN"), ("x5", 3000.0, 0.9, "CRITICAL")]
    assert sorted(r.alert_id for r in AN.alert_detail(alerts, gold, scores).collect() if r.amount is None) == ["x3", "x4"]
