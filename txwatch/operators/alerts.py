"""Alerts: percentile threshold, typed alerts, and the status workflow as an
append-only change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwatch import schemas as S
from txwatch.functions import rules as R
from txwatch.operators.selection import percentile_exact

THRESHOLD_DP = 6


def alert_threshold(gold: DataFrame, percentile: float = S.ALERT_PERCENTILE,
                    digits: int | None = THRESHOLD_DP) -> DataFrame:
    """One row ``threshold``: exact continuous percentile of ``rule_score``,
    rounded to ``digits`` for display (None: as it is, to compare with).

    The value is found by histograms of shrinking spans (``selection``), so a
    dense score costs no more than one with few values."""
    value = F.lit(percentile_exact(gold, "rule_score", percentile)).cast("double")
    return gold.sparkSession.range(1).select((value if digits is None else F.round(value, digits)).alias("threshold"))


def threshold_value(gold: DataFrame, percentile: float = S.ALERT_PERCENTILE) -> Column:
    """The unrounded threshold (one number, known when the plan is made)."""
    return F.lit(percentile_exact(gold, "rule_score", percentile)).cast("double")


def alert_id(run_ts: str) -> Column:
    return F.md5(F.concat(F.col("transaction_id"), F.lit(run_ts)))


def with_typology(gold: DataFrame) -> DataFrame:
    return gold.withColumn("typology", R.typology())


def generate_alerts(gold: DataFrame, run_ts: str,
                    percentile: float = S.ALERT_PERCENTILE) -> DataFrame:
    """Rows with ``rule_score >= p{percentile}`` become OPEN alerts."""
    thr = threshold_value(gold, percentile)
    created = F.lit(run_ts.replace("T", " ")).cast(T.TimestampNTZType())
    return gold.where(F.col("rule_score") >= thr).select(
        alert_id(run_ts).alias("alert_id"),
        "transaction_id",
        F.col("rule_score").alias("risk_score"),
        R.typology().alias("typology"),
        F.lit("OPEN").alias("status"),
        created.alias("created_at"),
        F.lit(None).cast(T.TimestampNTZType()).alias("updated_at"),
    )


def normalize_changes(changes: DataFrame) -> DataFrame:
    """Upper-case requested statuses and flag invalid ones."""
    return changes.withColumn("status", F.upper(F.trim(F.col("status"))))


def apply_status_changes(alerts: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(current alerts, rejected changes).

    ``changes`` is an append-only log ``(alert_id, status, changed_at)``.
    Valid changes for known alerts are reduced to the latest per alert with
    ``max_by`` (a partial aggregate) and applied with a left join; changes
    with an invalid status or an unknown alert id come back with a reason.
    """
    ch = normalize_changes(changes)
    valid = ch.where(F.col("status").isin(*S.ALERT_STATUSES))
    known = valid.join(alerts.select("alert_id"), "alert_id", "left_semi")
    latest = known.groupBy("alert_id").agg(
        F.max_by(F.struct("status", "changed_at"),
                 F.struct("changed_at", "status")).alias("_last"))
    current = (alerts.join(latest, "alert_id", "left")
               .withColumn("status", F.coalesce(F.col("_last.status"), F.col("status")))
               .withColumn("updated_at", F.coalesce(F.col("_last.changed_at"), F.col("updated_at")))
               .drop("_last"))
    invalid = (ch.where(~F.col("status").isin(*S.ALERT_STATUSES) | F.col("status").isNull())
               .withColumn("reason", F.lit("invalid_status")))
    unknown = (valid.join(alerts.select("alert_id"), "alert_id", "left_anti")
               .withColumn("reason", F.lit("alert_not_found")))
    return current, invalid.unionByName(unknown)
