"""Reporting queries over gold, alerts and scores (one function per report)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch import schemas as S
from txwatch.functions import columns as C
from txwatch.operators.standardize import only_ids_of


def summary_kpis(gold: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row: totals, laundering rate %, alert and open-alert counts. Each
    table is aggregated once; the alert counts enter as scalar subqueries."""
    a = alerts.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "OPEN").alias("o"))
    g = gold.agg(F.count(F.lit(1)).alias("total_transactions"),
                 F.sum("is_laundering").alias("total_laundering"))
    return g.select(
        "total_transactions",
        F.coalesce(F.col("total_laundering"), F.lit(0)).alias("total_laundering"),
        C.pct("total_laundering", "total_transactions", 4).alias("laundering_rate_pct"),
        a.select("n").scalar().alias("total_alerts"),
        a.select("o").scalar().alias("open_alerts"),
    )


def top_risk_senders(gold: DataFrame, min_score: float = 0.5, k: int = 10) -> DataFrame:
    return (gold.where(F.col("rule_score") >= min_score)
            .groupBy("sender_account_masked")
            .agg(F.count(F.lit(1)).alias("tx_count"),
                 C.round_half_up(F.avg("rule_score"), 4).alias("avg_rule_score"))
            .orderBy(F.desc("avg_rule_score"), F.asc("sender_account_masked"))
            .limit(k))


def daily_alerts(gold: DataFrame, alerts: DataFrame) -> DataFrame:
    """Alerts per transaction date (alerts carry run time, so join back)."""
    return (alerts.select("transaction_id")
            .join(gold.select("transaction_id", "timestamp"), "transaction_id")
            .groupBy(F.to_date("timestamp").alias("date"))
            .agg(F.count(F.lit(1)).alias("alert_count")))


def daily_stats(gold: DataFrame, alerts: DataFrame, date_from=None, date_to=None) -> DataFrame:
    tx = (gold.groupBy(F.to_date("timestamp").alias("date"))
          .agg(F.count(F.lit(1)).alias("transaction_count"),
               F.sum("is_laundering").alias("laundering_count"),
               C.round_half_up(F.avg("rule_score"), 4).alias("avg_rule_score")))
    out = (tx.join(daily_alerts(gold, alerts), "date", "left")
           .select("date", "transaction_count",
                   F.coalesce("laundering_count", F.lit(0)).alias("laundering_count"),
                   F.coalesce("avg_rule_score", F.lit(0.0)).alias("avg_rule_score"),
                   F.coalesce("alert_count", F.lit(0)).alias("alert_count")))
    if date_from is not None:
        out = out.where(F.col("date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        out = out.where(F.col("date") <= F.lit(date_to).cast("date"))
    return out.orderBy("date")


def payment_type_stats(gold: DataFrame) -> DataFrame:
    return (gold.groupBy("payment_type")
            .agg(F.count(F.lit(1)).alias("tx_count"),
                 C.round_half_up(F.avg("rule_score"), 4).alias("avg_rule_score"),
                 C.round_half_up(F.avg("amount"), 2).alias("avg_amount"),
                 F.sum("is_laundering").alias("laundering_count"))
            .withColumn("laundering_rate", C.pct("laundering_count", "tx_count", 4))
            .orderBy(F.desc("avg_rule_score"), "payment_type"))


def score_histogram(spark: SparkSession, scores: DataFrame, score: str = "ml_probability") -> DataFrame:
    """Ten bins of width 0.1 (1.0 falls in the last); empty bins kept at 0."""
    counts = (scores.where(F.col(score).isNotNull())
              .groupBy(C.histogram_bin(score).alias("bin"))
              .agg(F.count(F.lit(1)).alias("count")))
    bins = spark.range(10).select(F.col("id").cast("int").alias("bin"))
    return (bins.join(counts, "bin", "left")
            .select("bin", C.histogram_label("bin").alias("label"),
                    F.coalesce("count", F.lit(0)).alias("count"))
            .orderBy("bin"))


def risk_levels(spark: SparkSession, scores: DataFrame, score: str = "final_risk_score") -> DataFrame:
    """Count and share % per risk level; all four levels present."""
    counts = (scores.where(F.col(score).isNotNull())
              .groupBy(C.risk_level(score).alias("risk_level"))
              .agg(F.count(F.lit(1)).alias("count")))
    levels = spark.createDataFrame([(x,) for x in ("LOW", "MEDIUM", "HIGH", "CRITICAL")],
                                   "risk_level string")
    total = scores.where(F.col(score).isNotNull()).agg(F.count(F.lit(1))).scalar()
    return (levels.join(counts, "risk_level", "left")
            .select("risk_level", F.coalesce("count", F.lit(0)).alias("count"))
            .withColumn("pct", C.pct("count", total, 2)))


def score_summary(scores: DataFrame, score: str = "ml_probability") -> DataFrame:
    return scores.agg(F.count(F.lit(1)).alias("total"),
                      F.coalesce(C.round_half_up(F.avg(score), 4), F.lit(0.0)).alias("avg_score"))


def alert_status_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("status").agg(F.count(F.lit(1)).alias("count"))


def monitor_panels(gold: DataFrame, alerts: DataFrame) -> DataFrame:
    """Monitoring block: totals, open alerts, laundering rate, mean score."""
    k = summary_kpis(gold, alerts)
    avg = gold.agg(C.round_half_up(F.avg("rule_score"), 4)).scalar()
    return k.withColumn("avg_rule_score", avg)


def with_scores(gold: DataFrame, scores: DataFrame) -> DataFrame:
    """Transactions with their score and risk level (UNKNOWN if unscored)."""
    return (gold.join(scores, "transaction_id", "left")
            .withColumn("risk_level", C.risk_level("final_risk_score")))


TX_FIELDS = ("transaction_id", "timestamp", "amount", "payment_type", "payment_currency",
             "receiving_currency", "sender_account_masked", "receiver_account_masked",
             "sender_bank", "receiver_bank", "is_cross_currency", "is_laundering", "rule_score")


def transaction_scored(gold: DataFrame, scores: DataFrame) -> DataFrame:
    return with_scores(gold.select(*TX_FIELDS), scores).select(
        *TX_FIELDS, "ml_probability", "final_risk_score", "risk_level")


def transaction_lookup(gold: DataFrame, scores: DataFrame, tx_id) -> DataFrame:
    """Point lookup (``tx_id`` a literal or a scalar column); Parquet pushdown
    applies when it is a literal."""
    hit = gold.select(*TX_FIELDS).where(F.col("transaction_id") == tx_id)
    return with_scores(hit, scores).select(
        *TX_FIELDS, "ml_probability", "final_risk_score", "risk_level").limit(1)


def batch_lookup(ids: DataFrame, scores: DataFrame, max_ids: int | None = None) -> DataFrame:
    """``ids(ordinal, transaction_id)`` left-joined to scores in input order;
    unknown ids stay with UNKNOWN. ``max_ids`` is the request-size check."""
    if max_ids is not None:
        n = ids.count()
        if n > max_ids:
            raise ValueError(f"{n} ids were asked for at once; {max_ids} are allowed")
    return (ids.join(scores, "transaction_id", "left")
            .select("ordinal", "transaction_id", "ml_probability", "final_risk_score",
                    C.risk_level("final_risk_score").alias("risk_level"))
            .orderBy("ordinal"))


def alert_list(alerts: DataFrame, status: str | None = None, typology: str | None = None,
               limit: int = 100, offset: int = 0) -> DataFrame:
    if limit > 1000 or limit < 0 or offset < 0:
        raise ValueError("limit must be in [0, 1000] and offset >= 0")
    a = alerts
    if status:
        a = a.where(F.col("status") == status.upper())
    if typology:
        a = a.where(F.col("typology") == typology)
    return (a.select("alert_id", "transaction_id", "risk_score", "typology", "status", "created_at")
            .orderBy(F.desc("risk_score"), "alert_id").offset(offset).limit(limit))


def alert_search(alerts: DataFrame, date_from=None, date_to=None, min_score=None,
                 max_score=None, status=None, typology=None, limit: int | None = None,
                 offset: int = 0) -> DataFrame:
    """Every match, best first; ``limit`` and ``offset`` page through them."""
    a = alerts
    if status:
        a = a.where(F.col("status") == status.upper())
    if typology:
        a = a.where(F.col("typology") == typology)
    if date_from is not None:
        a = a.where(F.to_date("created_at") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        a = a.where(F.to_date("created_at") <= F.lit(date_to).cast("date"))
    if min_score is not None:
        a = a.where(F.col("risk_score") >= min_score)
    if max_score is not None:
        a = a.where(F.col("risk_score") <= max_score)
    found = (a.select("alert_id", "transaction_id", "risk_score", "typology", "status", "created_at")
             .orderBy(F.desc("risk_score"), "alert_id"))
    found = found.offset(offset) if offset else found
    return found if limit is None else found.limit(limit)


def alert_by_id(alerts: DataFrame, gold: DataFrame, scores: DataFrame, alert_id) -> DataFrame:
    """Detail of one alert (``alert_id`` a literal or a scalar column); no row
    for an unknown id."""
    return alert_detail(alerts.where(F.col("alert_id") == alert_id), gold, scores)


def alert_of_transaction(alerts: DataFrame, tx_id) -> DataFrame:
    """The alert of one transaction; no row if it has none."""
    return (alerts.where(F.col("transaction_id") == tx_id)
            .select("transaction_id", "alert_id", "risk_score", "typology", "status", "created_at"))


def alert_detail(alerts: DataFrame, gold: DataFrame, scores: DataFrame) -> DataFrame:
    """Alerts with their transaction and score (null without one). Of the two
    large tables only the rows that an alert may meet are moved."""
    gold, scores = only_ids_of(gold, alerts), only_ids_of(scores, alerts)
    t = gold.select("transaction_id", "amount", "payment_type", "sender_account_masked",
                    "receiver_account_masked", "timestamp", "is_laundering", "rule_score")
    return (alerts.select("alert_id", "transaction_id", "risk_score", "typology", "status", "created_at")
            .join(t, "transaction_id", "left")
            .join(scores.select("transaction_id", "ml_probability", "final_risk_score"),
                  "transaction_id", "left")
            .withColumn("risk_level", C.risk_level("final_risk_score"))
            .drop("final_risk_score"))


def alert_by_transaction(gold: DataFrame, alerts: DataFrame) -> DataFrame:
    """Alert of each laundering-labelled transaction that has one."""
    return (gold.where(F.col("is_laundering") == 1).select("transaction_id")
            .join(alerts.select("alert_id", "transaction_id", "risk_score", "typology",
                                "status", "created_at"), "transaction_id"))


def alert_export(alerts: DataFrame) -> DataFrame:
    """Export layout: score to 4 dp, minute-precision time, 8-char short id."""
    return alerts.select(
        "alert_id",
        F.substring("alert_id", 1, 8).alias("alert_short_id"),
        "transaction_id",
        C.round_half_up("risk_score", 4).alias("risk_score"),
        "typology", "status",
        F.date_format("created_at", "yyyy-MM-dd HH:mm").alias("created_at"))


def score_decisions(scores: DataFrame, threshold: float = S.DEFAULT_DECISION_THRESHOLD,
                    score: str = "final_risk_score") -> DataFrame:
    """Rounded probability, level and the suspicious flag at ``threshold``."""
    p = F.col(score)
    return scores.select(
        "transaction_id",
        C.round_half_up(p, 4).alias("ml_probability"),
        C.round_half_up(p, 4).alias("final_risk_score"),
        C.risk_level(p).alias("risk_level"),
        (p >= F.lit(threshold)).alias("is_suspicious"))


def duplicate_ids(df: DataFrame, id_col: str = "transaction_id") -> DataFrame:
    return (df.groupBy(id_col).agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


def distinct_partitions(silver: DataFrame) -> DataFrame:
    return silver.select(
        "source",
        F.year("timestamp").cast("string").alias("year"),
        F.lpad(F.month("timestamp").cast("string"), 2, "0").alias("month")).distinct()
