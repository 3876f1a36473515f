"""Pipeline-layer queries: bronze, silver, gold, alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from txwatch import schemas as S
from txwatch.functions import columns as C
from txwatch.operators import alerts as A
from txwatch.operators import features as FE
from txwatch.operators import ingest as I
from txwatch.oracle import TYPOLOGY, with_layers
from txwatch.plans.catalog import register
from txwatch.plans.pipeline import ledger

GOLD_COLS = ", ".join(S.GOLD_COLUMNS)


@register("alerts_by_typology", with_layers("""
SELECT typology, COUNT(*) AS alert_count,
       CAST(round(CAST(AVG(risk_score) AS DECIMAL(38,12)), 4) AS DOUBLE) AS avg_score
FROM alerts GROUP BY typology"""))
def alerts_by_typology(spark, sf):
    a = ledger(spark, sf).alerts
    return a.groupBy("typology").agg(
        F.count(F.lit(1)).alias("alert_count"),
        C.round_half_up(F.avg("risk_score"), 4).alias("avg_score"))


@register("gold_features", with_layers(f"SELECT {GOLD_COLS} FROM gold", "gold"))
def gold_features(spark, sf):
    return ledger(spark, sf).gold


@register("sender_velocity_1h", with_layers("""
SELECT transaction_id, sender_account_masked, timestamp, sender_tx_count_1h, sender_amount_sum_1h
FROM gold""", "gold"))
def sender_velocity_1h(spark, sf):
    silver = ledger(spark, sf).silver
    return FE.sender_velocity(silver).select(
        "transaction_id", "sender_account_masked", "timestamp",
        "sender_tx_count_1h", "sender_amount_sum_1h")


@register("sender_baseline", with_layers("""
SELECT sender_account_masked, MIN(sender_avg_amount) AS sender_avg_amount, COUNT(*) AS tx_count
FROM gold GROUP BY sender_account_masked""", "gold"))
def sender_baseline(spark, sf):
    g = ledger(spark, sf).gold
    return g.groupBy("sender_account_masked").agg(
        F.min("sender_avg_amount").alias("sender_avg_amount"),
        F.count(F.lit(1)).alias("tx_count"))


@register("sender_baseline_trailing", with_layers("""
SELECT transaction_id, sender_account_masked, timestamp,
  CAST(SUM(CAST(amount AS DECIMAL(24,6))) OVER w AS DOUBLE) / CAST(COUNT(amount) OVER w AS DOUBLE)
    AS sender_avg_amount_trailing
FROM silver
WINDOW w AS (PARTITION BY sender_account_masked ORDER BY timestamp
             RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", "silver"))
def sender_baseline_trailing(spark, sf):
    """Leak-free sender baseline: average amount up to each transaction."""
    return FE.sender_trailing_baseline(ledger(spark, sf).silver).select(
        "transaction_id", "sender_account_masked", "timestamp", "sender_avg_amount_trailing")


@register("alert_threshold", with_layers("SELECT threshold FROM thr"))
def alert_threshold(spark, sf):
    return A.alert_threshold(ledger(spark, sf).gold)


@register("alerts", with_layers("SELECT * FROM alerts"))
def alerts(spark, sf):
    return ledger(spark, sf).alerts


@register("typology_all", with_layers(f"""
SELECT typology, COUNT(*) AS tx_count FROM (SELECT {TYPOLOGY} AS typology FROM gold) t
GROUP BY typology""", "gold"))
def typology_all(spark, sf):
    g = A.with_typology(ledger(spark, sf).gold)
    return g.groupBy("typology").agg(F.count(F.lit(1)).alias("tx_count"))


@register("silver_standardize", with_layers(
    f"SELECT {', '.join(S.SILVER_COLUMNS)} FROM silver", "silver"))
def silver_standardize(spark, sf):
    return ledger(spark, sf).silver


@register("dedup_kept", with_layers("""
SELECT chunk_id, COUNT(*) AS kept_rows, COUNT(DISTINCT transaction_id) AS kept_ids
FROM marked WHERE dead_reason IS NULL GROUP BY chunk_id""", "silver"))
def dedup_kept(spark, sf):
    kept = ledger(spark, sf)._dedup.where(F.col("dead_reason").isNull())
    return kept.groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("kept_rows"),
        F.count_distinct("transaction_id").alias("kept_ids"))


@register("dedup_dead", with_layers("""
SELECT transaction_id, chunk_id, src_orderkey, src_linenumber, copy_no, dead_reason
FROM silver_dead""", "silver"))
def dedup_dead(spark, sf):
    return ledger(spark, sf).silver_dead.select(
        "transaction_id", "chunk_id", "src_orderkey", "src_linenumber", "copy_no", "dead_reason")


BRONZE_OUT = ('"Timestamp", "Account_sender", "Account_receiver", "Amount Paid", '
              '"Payment Format", chunk_id, copy_no')


@register("dead_letter", with_layers(f"SELECT {BRONZE_OUT} FROM dead_letter", "silver"))
def dead_letter(spark, sf):
    return ledger(spark, sf).dead_letter.select(
        "Timestamp", "Account_sender", "Account_receiver", "Amount Paid",
        "Payment Format", "chunk_id", "copy_no")


@register("clean_rows", with_layers("""
SELECT chunk_id, COUNT(*) AS row_count, CAST(SUM(CAST("Amount Paid" AS DECIMAL(24,6))) AS DOUBLE) AS amount_sum
FROM clean GROUP BY chunk_id""", "silver"))
def clean_rows(spark, sf):
    return ledger(spark, sf).clean.groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("Amount Paid").cast("decimal(24,6)")).cast("double").alias("amount_sum"))


@register("bronze_partition_counts", with_layers("""
SELECT CAST(year(CAST(try_strptime("Timestamp", '%Y-%m-%d %H:%M:%S') AS TIMESTAMP)) AS VARCHAR) AS year,
       lpad(CAST(month(CAST(try_strptime("Timestamp", '%Y-%m-%d %H:%M:%S') AS TIMESTAMP)) AS VARCHAR), 2, '0') AS month,
       COUNT(*) AS row_count
FROM bronze GROUP BY 1, 2""", "bronze"))
def bronze_partition_counts(spark, sf):
    return I.partition_counts(ledger(spark, sf).bronze)
