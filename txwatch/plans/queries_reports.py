"""Serving/report queries, metrics and quality gates with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from txwatch import schemas as S
from txwatch.operators import analytics as AN
from txwatch.operators import metrics as M
from txwatch.operators import ml as ML
from txwatch.operators import quality as Q
from txwatch.oracle import CREATED_AT, STATUS_NOW, with_layers
from txwatch.plans.catalog import register
from txwatch.plans.pipeline import ledger


def r4(x: str, d: int = 4) -> str:
    """SQL twin of round_half_up: through decimal, back to double."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,12)), {d}) AS DOUBLE)"


def pct_sql(num: str, den: str, d: int = 4) -> str:
    return (f"coalesce(CAST(round(CAST(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0) * 100 "
            f"AS DECIMAL(38,12)), {d}) AS DOUBLE), 0.0)")


# ---------------------------------------------------------------- KPIs --
@register("summary_kpis", with_layers(f"""
SELECT COUNT(*) AS total_transactions, CAST(coalesce(SUM(is_laundering), 0) AS BIGINT) AS total_laundering,
       {pct_sql('SUM(is_laundering)', 'COUNT(*)')} AS laundering_rate_pct,
       (SELECT COUNT(*) FROM alerts_cur) AS total_alerts,
       (SELECT COUNT(*) FROM alerts_cur WHERE status = 'OPEN') AS open_alerts
FROM gold"""))
def summary_kpis(spark, sf):
    lg = ledger(spark, sf)
    return AN.summary_kpis(lg.gold, lg.alerts_current)


@register("monitor_panels", with_layers(f"""
SELECT COUNT(*) AS total_transactions, CAST(coalesce(SUM(is_laundering), 0) AS BIGINT) AS total_laundering,
       {pct_sql('SUM(is_laundering)', 'COUNT(*)')} AS laundering_rate_pct,
       (SELECT COUNT(*) FROM alerts_cur) AS total_alerts,
       (SELECT COUNT(*) FROM alerts_cur WHERE status = 'OPEN') AS open_alerts,
       {r4('AVG(rule_score)')} AS avg_rule_score
FROM gold"""))
def monitor_panels(spark, sf):
    lg = ledger(spark, sf)
    return AN.monitor_panels(lg.gold, lg.alerts_current)


@register("top_risk_senders", with_layers(f"""
SELECT sender_account_masked, COUNT(*) AS tx_count, {r4('AVG(rule_score)')} AS avg_rule_score
FROM gold WHERE rule_score >= 0.5 GROUP BY sender_account_masked
ORDER BY avg_rule_score DESC, sender_account_masked LIMIT 10""", "gold"))
def top_risk_senders(spark, sf):
    return AN.top_risk_senders(ledger(spark, sf).gold)


DAILY_SQL = f"""
tx AS (SELECT CAST(timestamp AS DATE) AS date, COUNT(*) AS transaction_count,
              CAST(SUM(is_laundering) AS BIGINT) AS laundering_count, {r4('AVG(rule_score)')} AS avg_rule_score
       FROM gold GROUP BY 1),
al AS (SELECT CAST(t.timestamp AS DATE) AS date, COUNT(*) AS alert_count
       FROM alerts a JOIN gold t ON a.transaction_id = t.transaction_id GROUP BY 1),
daily AS (SELECT tx.date, transaction_count, coalesce(laundering_count, 0) AS laundering_count,
                 coalesce(avg_rule_score, 0.0) AS avg_rule_score, coalesce(alert_count, 0) AS alert_count
          FROM tx LEFT JOIN al ON tx.date = al.date)"""


@register("daily_stats", with_layers(f", {DAILY_SQL.strip()}\nSELECT * FROM daily")
          .replace("\n, tx AS", ",\ntx AS"))
def daily_stats(spark, sf):
    lg = ledger(spark, sf)
    return AN.daily_stats(lg.gold, lg.alerts)


@register("daily_stats_range", with_layers(f", {DAILY_SQL.strip()}\nSELECT * FROM daily "
                                           "WHERE date BETWEEN DATE '2022-09-03' AND DATE '2022-09-10'")
          .replace("\n, tx AS", ",\ntx AS"))
def daily_stats_range(spark, sf):
    lg = ledger(spark, sf)
    return AN.daily_stats(lg.gold, lg.alerts, "2022-09-03", "2022-09-10")


@register("daily_alerts", with_layers("""
SELECT CAST(t.timestamp AS DATE) AS date, COUNT(*) AS alert_count
FROM alerts a JOIN gold t ON a.transaction_id = t.transaction_id GROUP BY 1"""))
def daily_alerts(spark, sf):
    lg = ledger(spark, sf)
    return AN.daily_alerts(lg.gold, lg.alerts)


@register("payment_type_stats", with_layers(f"""
SELECT payment_type, COUNT(*) AS tx_count, {r4('AVG(rule_score)')} AS avg_rule_score,
       {r4('AVG(amount)', 2)} AS avg_amount, CAST(SUM(is_laundering) AS BIGINT) AS laundering_count,
       {pct_sql('SUM(is_laundering)', 'COUNT(*)')} AS laundering_rate
FROM gold GROUP BY payment_type""", "gold"))
def payment_type_stats(spark, sf):
    return AN.payment_type_stats(ledger(spark, sf).gold)


HIST_LABELS = "[" + ", ".join(f"'{x}'" for x in S.HISTOGRAM_LABELS) + "]"


@register("score_histogram", with_layers(f"""
SELECT CAST(b.bin AS INTEGER) AS bin, {HIST_LABELS}[b.bin + 1] AS label, coalesce(c.cnt, 0) AS count
FROM range(10) b(bin) LEFT JOIN (
  SELECT CAST(least(floor(ml_probability * 10), 9) AS INTEGER) AS bin, COUNT(*) AS cnt
  FROM scores WHERE ml_probability IS NOT NULL GROUP BY 1) c ON b.bin = c.bin"""))
def score_histogram(spark, sf):
    return AN.score_histogram(spark, ledger(spark, sf).scores)


RISK_LEVEL_SQL = """CASE WHEN {s} IS NULL THEN 'UNKNOWN' WHEN {s} >= 0.9 THEN 'CRITICAL'
  WHEN {s} >= 0.7 THEN 'HIGH' WHEN {s} >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END"""


@register("risk_levels", with_layers(f"""
SELECT l.risk_level, coalesce(c.cnt, 0) AS count,
       {pct_sql('coalesce(c.cnt, 0)', '(SELECT COUNT(*) FROM scores WHERE final_risk_score IS NOT NULL)', 2)} AS pct
FROM (VALUES ('LOW'), ('MEDIUM'), ('HIGH'), ('CRITICAL')) l(risk_level) LEFT JOIN (
  SELECT {RISK_LEVEL_SQL.format(s='final_risk_score')} AS risk_level, COUNT(*) AS cnt
  FROM scores WHERE final_risk_score IS NOT NULL GROUP BY 1) c ON l.risk_level = c.risk_level"""))
def risk_levels(spark, sf):
    return AN.risk_levels(spark, ledger(spark, sf).scores)


@register("score_summary", with_layers(f"""
SELECT COUNT(*) AS total, coalesce({r4('AVG(ml_probability)')}, 0.0) AS avg_score FROM scores"""))
def score_summary(spark, sf):
    return AN.score_summary(ledger(spark, sf).scores)


@register("alert_status_counts", with_layers("SELECT status, COUNT(*) AS count FROM alerts_cur GROUP BY status"))
def alert_status_counts(spark, sf):
    return AN.alert_status_counts(ledger(spark, sf).alerts_current)


@register("alert_status_current", with_layers(
    "SELECT alert_id, transaction_id, status, created_at, updated_at FROM alerts_cur"))
def alert_status_current(spark, sf):
    return ledger(spark, sf).alerts_current.select(
        "alert_id", "transaction_id", "status", "created_at", "updated_at")


@register("alert_status_rejected", with_layers("SELECT alert_id, status, changed_at, reason FROM rejected"))
def alert_status_rejected(spark, sf):
    return ledger(spark, sf).status_rejected.select("alert_id", "status", "changed_at", "reason")


# ------------------------------------------------------------ lookups --
TXF = ", ".join(AN.TX_FIELDS)
TXF_G = ", ".join(f"g.{c}" for c in AN.TX_FIELDS)


@register("transaction_scored", with_layers(f"""
SELECT {TXF_G}, s.ml_probability, s.final_risk_score,
       {RISK_LEVEL_SQL.format(s='s.final_risk_score')} AS risk_level
FROM gold g LEFT JOIN scores s ON g.transaction_id = s.transaction_id"""))
def transaction_scored(spark, sf):
    lg = ledger(spark, sf)
    return AN.transaction_scored(lg.gold, lg.scores)


@register("transaction_lookup", with_layers(f"""
SELECT {TXF_G}, s.ml_probability, s.final_risk_score,
       {RISK_LEVEL_SQL.format(s='s.final_risk_score')} AS risk_level
FROM gold g LEFT JOIN scores s ON g.transaction_id = s.transaction_id
WHERE g.transaction_id = (SELECT min(transaction_id) FROM alerts)"""))
def transaction_lookup(spark, sf):
    """Look up the first alerted transaction (key taken from the data)."""
    lg = ledger(spark, sf)
    key = lg.alerts.agg(F.min("transaction_id")).scalar()
    return AN.transaction_lookup(lg.gold, lg.scores, key)


@register("batch_lookup", with_layers(f"""
SELECT '0:' || transaction_id AS ordinal, transaction_id, rule_score AS ml_probability, rule_score AS final_risk_score,
       {RISK_LEVEL_SQL.format(s='rule_score')} AS risk_level
FROM hits
UNION ALL
SELECT '1:unknown-' || transaction_id, 'unknown-' || transaction_id, NULL, NULL, 'UNKNOWN'
FROM hits WHERE hit_typology = 'structuring'""", "hits"))
def batch_lookup(spark, sf):
    """Every alerted id plus unknown ids, kept in request order. The request
    key ``ordinal`` sorts in request order (group, then id), so no global
    numbering window is needed; the request API applies ``max_ids``."""
    a = ledger(spark, sf).alerts
    known = a.select(F.concat(F.lit("0:"), "transaction_id").alias("ordinal"), "transaction_id")
    unknown = (a.where(F.col("typology") == "structuring")
               .select(F.concat(F.lit("1:unknown-"), "transaction_id").alias("ordinal"),
                       F.concat(F.lit("unknown-"), "transaction_id").alias("transaction_id")))
    return AN.batch_lookup(known.unionByName(unknown), ledger(spark, sf).scores)


ALERT_COLS = "alert_id, transaction_id, risk_score, typology, status, created_at"


@register("alert_list", with_layers(f"""
SELECT {ALERT_COLS} FROM alerts_cur WHERE status = 'OPEN' AND typology = 'cross_currency_high_risk'
ORDER BY risk_score DESC, alert_id LIMIT 100 OFFSET 10"""))
def alert_list(spark, sf):
    return AN.alert_list(ledger(spark, sf).alerts_current, status="open",
                         typology="cross_currency_high_risk", limit=100, offset=10)


@register("alert_search", with_layers(f"""
SELECT alert_id, transaction_id, rule_score AS risk_score, hit_typology AS typology, {STATUS_NOW} AS status, {CREATED_AT} AS created_at
FROM hits WHERE rule_score >= 0.6 AND rule_score <= 0.9
  AND {CREATED_AT} >= TIMESTAMP '2022-09-18 00:00:00' AND {CREATED_AT} < TIMESTAMP '2022-09-19 00:00:00'""", "hits"))
def alert_search(spark, sf):
    return AN.alert_search(ledger(spark, sf).alerts_current, date_from="2022-09-18",
                           date_to="2022-09-18", min_score=0.6, max_score=0.9)


#: Alerts are rows of gold, so their detail needs no join in the twin.
DETAIL_SQL = f"""
SELECT alert_id, transaction_id, rule_score AS risk_score, hit_typology AS typology, {STATUS_NOW} AS status, {CREATED_AT} AS created_at,
       amount, payment_type, sender_account_masked, receiver_account_masked, timestamp, is_laundering, rule_score,
       rule_score AS ml_probability, {RISK_LEVEL_SQL.format(s='rule_score')} AS risk_level
FROM hits"""


@register("alert_by_id", with_layers(DETAIL_SQL + " ORDER BY alert_id DESC LIMIT 1", "hits"))
def alert_by_id(spark, sf):
    """One alert's detail (the key is taken from the data)."""
    lg = ledger(spark, sf)
    return AN.alert_by_id(lg.alerts_current, lg.gold, lg.scores, lg.alerts.agg(F.max("alert_id")).scalar())


@register("alert_of_transaction", with_layers(f"""
SELECT transaction_id, alert_id, risk_score, typology, status, created_at
FROM alerts_cur WHERE transaction_id = (SELECT max(transaction_id) FROM alerts)"""))
def alert_of_transaction(spark, sf):
    """The alert of one transaction (the key is taken from the data)."""
    lg = ledger(spark, sf)
    return AN.alert_of_transaction(lg.alerts_current, lg.alerts.agg(F.max("transaction_id")).scalar())


@register("alert_detail", with_layers(DETAIL_SQL, "hits"))
def alert_detail(spark, sf):
    lg = ledger(spark, sf)
    return AN.alert_detail(lg.alerts_current, lg.gold, lg.scores)


@register("alert_by_transaction", with_layers(f"""
SELECT transaction_id, alert_id, rule_score AS risk_score, hit_typology AS typology, {STATUS_NOW} AS status, {CREATED_AT} AS created_at
FROM hits WHERE is_laundering = 1""", "hits"))
def alert_by_transaction(spark, sf):
    lg = ledger(spark, sf)
    return AN.alert_by_transaction(lg.gold, lg.alerts_current)


@register("alert_export", with_layers(f"""
SELECT alert_id, substr(alert_id, 1, 8) AS alert_short_id, transaction_id,
       {r4('rule_score')} AS risk_score, hit_typology AS typology, {STATUS_NOW} AS status,
       strftime({CREATED_AT}, '%Y-%m-%d %H:%M') AS created_at
FROM hits""", "hits"))
def alert_export(spark, sf):
    return AN.alert_export(ledger(spark, sf).alerts_current)


@register("score_decisions", with_layers(f"""
SELECT transaction_id, {r4('final_risk_score')} AS ml_probability, {r4('final_risk_score')} AS final_risk_score,
       {RISK_LEVEL_SQL.format(s='final_risk_score')} AS risk_level, final_risk_score >= 0.9 AS is_suspicious
FROM scores"""))
def score_decisions(spark, sf):
    return AN.score_decisions(ledger(spark, sf).scores)


@register("duplicate_ids", with_layers("""
SELECT transaction_id, COUNT(*) AS copies FROM std GROUP BY transaction_id HAVING COUNT(*) > 1""", "silver"))
def duplicate_ids(spark, sf):
    return AN.duplicate_ids(ledger(spark, sf).standardized)


@register("distinct_partitions", with_layers("""
SELECT DISTINCT source, CAST(year(timestamp) AS VARCHAR) AS year,
       lpad(CAST(month(timestamp) AS VARCHAR), 2, '0') AS month FROM silver""", "silver"))
def distinct_partitions(spark, sf):
    return AN.distinct_partitions(ledger(spark, sf).silver)


# ------------------------------------------------------------ metrics --
EVAL = (f", ev AS (SELECT rule_score AS score, is_laundering AS label FROM gold "
        f"WHERE timestamp > TIMESTAMP '{S.TRAIN_END}' AND timestamp <= TIMESTAMP '{S.VAL_END}')")


def _eval_frame(spark, sf):
    ds = ML.ml_dataset(ledger(spark, sf).gold)
    return ds.where(F.col("split") == "val").select(
        F.col("rule_score").alias("score"), F.col(S.TARGET).alias("label"))


def with_eval(body: str) -> str:
    return with_layers(EVAL + "\n" + body, "gold").replace("\n, ev AS", ",\nev AS")


SWEEP_SQL = ", sw0 AS (" + " UNION ALL ".join(
    f"SELECT CAST({i / 20!r} AS DOUBLE) AS threshold, "
    f"CAST(count_if(score >= {t}) AS BIGINT) AS predicted_pos, "
    f"CAST(count_if(score >= {t} AND label = 1) AS BIGINT) AS tp, "
    f"CAST(count_if(label = 1) AS BIGINT) AS P, COUNT(*) AS n FROM ev"
    for i, t in M.sweep_thresholds()) + """),
sw AS (SELECT threshold, predicted_pos, tp, predicted_pos - tp AS fp, P - tp AS fn,
  coalesce(CAST(tp AS DOUBLE) / NULLIF(CAST(predicted_pos AS DOUBLE), 0), 0.0) AS precision,
  coalesce(CAST(tp AS DOUBLE) / NULLIF(CAST(P AS DOUBLE), 0), 0.0) AS recall,
  coalesce(CAST(2 * tp AS DOUBLE) / NULLIF(CAST(P + predicted_pos AS DOUBLE), 0), 0.0) AS f1,
  CAST(round(CAST(coalesce(CAST(predicted_pos AS DOUBLE) / NULLIF(CAST(n AS DOUBLE), 0), 0.0) * 100
        AS DECIMAL(38,12)), 2) AS DOUBLE) AS flagged_pct
  FROM sw0),
best AS (SELECT threshold, f1 FROM (
  SELECT threshold, f1, 0 AS d FROM sw WHERE predicted_pos > 0 AND f1 > 0
  UNION ALL SELECT 0.5, 0.0, 1) ORDER BY f1 DESC, d, threshold LIMIT 1)"""

CM_AT_BEST = """cm AS (SELECT CAST(count_if(score < (SELECT threshold FROM best) AND label <> 1) AS BIGINT) AS tn,
  CAST(count_if(score >= (SELECT threshold FROM best) AND label <> 1) AS BIGINT) AS fp,
  CAST(count_if(score < (SELECT threshold FROM best) AND label = 1) AS BIGINT) AS fn,
  CAST(count_if(score >= (SELECT threshold FROM best) AND label = 1) AS BIGINT) AS tp FROM ev)"""


def _best(spark, sf):
    return M.best_threshold(M.threshold_sweep(_eval_frame(spark, sf)))


@register("threshold_sweep", with_eval(SWEEP_SQL + "\nSELECT * FROM sw"))
def threshold_sweep(spark, sf):
    return M.threshold_sweep(_eval_frame(spark, sf))


@register("best_threshold", with_eval(SWEEP_SQL + "\nSELECT * FROM best"))
def best_threshold(spark, sf):
    return _best(spark, sf)


@register("confusion_matrix", with_eval(SWEEP_SQL + ",\n" + CM_AT_BEST + "\nSELECT * FROM cm"))
def confusion_matrix(spark, sf):
    thr = _best(spark, sf).select("threshold").scalar()
    return M.confusion(_eval_frame(spark, sf), thr)


MET_SQL = """SELECT *, coalesce(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fp AS DOUBLE), 0), 0.0) AS precision,
  coalesce(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0.0) AS recall,
  coalesce(CAST(2 * tp AS DOUBLE) / NULLIF(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0) AS f1 FROM cm"""


@register("classification_metrics", with_eval(SWEEP_SQL + ",\n" + CM_AT_BEST + "\n" + MET_SQL))
def classification_metrics(spark, sf):
    thr = _best(spark, sf).select("threshold").scalar()
    return M.from_confusion(M.confusion(_eval_frame(spark, sf), thr))


def _sd(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)"


REPORT_SQL = f""",
rp AS (SELECT {_sd('tn', 'tn + fn')} AS p0, {_sd('tn', 'tn + fp')} AS r0, {_sd('2 * tn', '2 * tn + fn + fp')} AS f0,
  {_sd('tp', 'tp + fp')} AS p1, {_sd('tp', 'tp + fn')} AS r1, {_sd('2 * tp', '2 * tp + fp + fn')} AS f1,
  tn + fp AS s0, tp + fn AS s1, tn + fp + tp + fn AS n, {_sd('tp + tn', 'tn + fp + tp + fn')} AS acc,
  {_sd('tn + fp', 'tn + fp + tp + fn')} AS w0, {_sd('tp + fn', 'tn + fp + tp + fn')} AS w1 FROM cm)
SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, CAST(s0 AS BIGINT) AS support FROM rp
UNION ALL SELECT '1', p1, r1, f1, CAST(s1 AS BIGINT) FROM rp
UNION ALL SELECT 'accuracy', NULL, NULL, acc, CAST(n AS BIGINT) FROM rp
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, CAST(n AS BIGINT) FROM rp
UNION ALL SELECT 'weighted avg', p0 * w0 + p1 * w1, r0 * w0 + r1 * w1, f0 * w0 + f1 * w1, CAST(n AS BIGINT) FROM rp"""


@register("classification_report", with_eval(SWEEP_SQL + ",\n" + CM_AT_BEST + REPORT_SQL))
def classification_report(spark, sf):
    thr = _best(spark, sf).select("threshold").scalar()
    return M.classification_report(M.confusion(_eval_frame(spark, sf), thr))


SCORE_TABLE_SQL = """, st0 AS (SELECT score, count_if(label = 1) AS pos, count_if(label <> 1) AS neg FROM ev GROUP BY score),
st AS (SELECT score, pos, neg,
  coalesce(SUM(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_below,
  coalesce(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
  SUM(pos) OVER () AS P, SUM(neg) OVER () AS N FROM st0)"""


@register("auc_roc", with_eval(SCORE_TABLE_SQL + """
SELECT CASE WHEN max(P) > 0 AND max(N) > 0 THEN
  SUM(CAST(pos AS DOUBLE) * (CAST(neg_below AS DOUBLE) + CAST(neg AS DOUBLE) * 0.5))
  / (CAST(max(P) AS DOUBLE) * CAST(max(N) AS DOUBLE)) END AS auc_roc FROM st"""))
def auc_roc(spark, sf):
    return M.auc_roc(_eval_frame(spark, sf))


@register("auc_pr", with_eval(SCORE_TABLE_SQL + """
SELECT CASE WHEN max(P) > 0 THEN CAST(round(CAST(SUM(CASE WHEN pos > 0 THEN
  CAST(pos AS DOUBLE) / CAST(P AS DOUBLE) * ((CAST(P AS DOUBLE) - CAST(pos_below AS DOUBLE))
  / ((CAST(P AS DOUBLE) - CAST(pos_below AS DOUBLE)) + (CAST(N AS DOUBLE) - CAST(neg_below AS DOUBLE)))) END)
  AS DECIMAL(38,16)), 10) AS DOUBLE) END AS auc_pr FROM st"""))
def auc_pr(spark, sf):
    return M.average_precision(_eval_frame(spark, sf))


def _ranked_sql(frame: str) -> str:
    """ROC-AUC and average precision by group from ranks and running counts."""
    return f"""
, ev AS ({frame}),
g0 AS (SELECT split, score, count_if(label = 1) AS pos, count_if(label <> 1) AS neg FROM ev GROUP BY split, score),
g AS (SELECT *, SUM(pos) OVER w - pos AS pos_below, SUM(neg) OVER w - neg AS neg_below,
      SUM(pos) OVER (PARTITION BY split) AS P, SUM(neg) OVER (PARTITION BY split) AS N
      FROM g0 WINDOW w AS (PARTITION BY split ORDER BY score))
SELECT split, CAST(round(CAST(SUM(CAST(pos AS DOUBLE) * (neg_below + neg * 0.5)) / (CAST(max(P) AS DOUBLE) * max(N))
         AS DECIMAL(38,16)), 10) AS DOUBLE) AS auc_roc,
       CAST(round(CAST(SUM(CASE WHEN pos > 0 THEN CAST(pos AS DOUBLE) / P * (CAST(P - pos_below AS DOUBLE)
         / (P - pos_below + N - neg_below)) END) AS DECIMAL(38,16)), 10) AS DOUBLE) AS auc_pr
FROM g GROUP BY split""".replace("\n, ev AS", ",\nev AS")


def _curve_rows(frames):
    """One row a split, both areas from one score table."""
    out = None
    for split, df in frames:
        auc = F.round(F.col("auc_roc").cast("decimal(38,16)"), 10).cast("double")
        row = M.areas(df).select(F.lit(split).alias("split"), auc.alias("auc_roc"), "auc_pr")
        out = row if out is None else out.unionByName(row)
    return out


@register("auc_by_split", with_layers(_ranked_sql(f"""
  SELECT CASE WHEN timestamp <= TIMESTAMP '{S.VAL_END}' THEN 'val' ELSE 'test' END AS split,
         rule_score AS score, is_laundering AS label FROM gold WHERE timestamp > TIMESTAMP '{S.TRAIN_END}'"""), "gold"))
def auc_by_split(spark, sf):
    """AUC and average precision of the rule score on val and on test."""
    ds = ML.ml_dataset(ledger(spark, sf).gold)
    return _curve_rows([(x, ds.where(F.col("split") == x).select(F.col("rule_score").alias("score"), F.col(S.TARGET).alias("label")))
                        for x in ("val", "test")])


@register("auc_dense_score", with_layers(_ranked_sql("""
  SELECT 'all' AS split, CAST('0x' || substr(md5(transaction_id), 1, 13) AS BIGINT) / 4503599627370496.0 AS score,
         is_laundering AS label FROM gold"""), "gold"))
def auc_dense_score(spark, sf):
    """The same for a score with as many values as rows (a hash of the id)."""
    dense = F.conv(F.substring(F.md5("transaction_id"), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))
    gold = ledger(spark, sf).gold.select(dense.alias("score"), F.col(S.TARGET).alias("label"))
    return _curve_rows([("all", gold)])


@register("model_gate", with_eval(SWEEP_SQL + ",\n" + CM_AT_BEST + SCORE_TABLE_SQL.replace(
    ", st0 AS", ",\nst0 AS") + """,
au AS (SELECT CASE WHEN max(P) > 0 AND max(N) > 0 THEN
  SUM(CAST(pos AS DOUBLE) * (CAST(neg_below AS DOUBLE) + CAST(neg AS DOUBLE) * 0.5))
  / (CAST(max(P) AS DOUBLE) * CAST(max(N) AS DOUBLE)) END AS v FROM st),
rc AS (SELECT coalesce(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0.0) AS v FROM cm)
SELECT 'auc_roc' AS metric, (SELECT v FROM au) AS value, CAST(0.85 AS DOUBLE) AS minimum,
       coalesce((SELECT v FROM au) >= 0.85, false) AS passed
UNION ALL SELECT 'recall', (SELECT v FROM rc), CAST(0.2 AS DOUBLE), coalesce((SELECT v FROM rc) >= 0.2, false)"""))
def model_gate(spark, sf):
    ev = _eval_frame(spark, sf)
    auc = M.auc_roc(ev).scalar()
    thr = _best(spark, sf).select("threshold").scalar()
    rec = M.from_confusion(M.confusion(ev, thr)).select("recall").scalar()
    return M.model_gate(auc, rec, spark=spark)


@register("ml_split", with_layers(f"""
SELECT CASE WHEN timestamp <= TIMESTAMP '{S.TRAIN_END}' THEN 'train'
            WHEN timestamp <= TIMESTAMP '{S.VAL_END}' THEN 'val' ELSE 'test' END AS split,
       COUNT(*) AS row_count, CAST(SUM(is_laundering) AS BIGINT) AS positives
FROM gold GROUP BY 1""", "gold"))
def ml_split(spark, sf):
    ds = ML.ml_dataset(ledger(spark, sf).gold)
    return ds.groupBy("split").agg(F.count(F.lit(1)).alias("row_count"),
                                   F.sum(S.TARGET).alias("positives"))


@register("class_balance", with_layers(f"""
SELECT pos, neg, CASE WHEN pos > 0 THEN CAST(round(CAST(CAST(neg AS DOUBLE) / CAST(pos AS DOUBLE)
  AS DECIMAL(38,12)), 2) AS DOUBLE) ELSE 1000.0 END AS scale_pos_weight
FROM (SELECT CAST(count_if(is_laundering = 1) AS BIGINT) AS pos, CAST(count_if(is_laundering = 0) AS BIGINT) AS neg
      FROM gold WHERE timestamp <= TIMESTAMP '{S.TRAIN_END}')""", "gold"))
def class_balance(spark, sf):
    return ML.class_balance(ML.ml_dataset(ledger(spark, sf).gold))


# ------------------------------------------------------------ quality --
def _rule_rows(rules: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS rule, CAST(coalesce({v}, 0) AS BIGINT) AS violations, "
        f"coalesce({v}, 0) = 0 AS passed FROM a" for n, v in rules)


@register("gate_silver", with_layers("""
, ids AS (SELECT transaction_id, COUNT(*) AS c, count_if(amount < 0) AS neg,
   count_if(is_laundering NOT IN (0, 1) OR is_laundering IS NULL) AS bl FROM silver GROUP BY transaction_id),
a AS (SELECT SUM(c) AS total, SUM(CASE WHEN transaction_id IS NULL THEN c END) AS null_id, SUM(neg) AS neg,
   count_if(transaction_id IS NOT NULL AND c > 1) AS dup, SUM(bl) AS bl FROM ids)
""".replace("\n, ids AS", ",\nids AS") + _rule_rows([
    ("null_transaction_id", "null_id"), ("negative_amount", "neg"),
    ("duplicate_transaction_id", "dup"), ("invalid_label", "bl"),
    ("min_rows", "CASE WHEN total < 6000000 THEN 1 ELSE 0 END")]), "silver"))
def gate_silver(spark, sf):
    return Q.gate_silver(ledger(spark, sf).silver)


@register("gate_gold", with_layers("""
, a AS (SELECT COUNT(*) AS total, count_if(transaction_id IS NULL) AS null_id,
   count_if(rule_score IS NULL) AS ns, count_if(rule_score < 0 OR rule_score > 1) AS bs,
   count_if(sender_tx_count_1h IS NULL) AS n1, count_if(amount_vs_sender_avg IS NULL) AS nr FROM gold)
""".replace("\n, a AS", ",\na AS") + _rule_rows([
    ("null_transaction_id", "null_id"), ("null_rule_score", "ns"), ("rule_score_out_of_range", "bs"),
    ("null_sender_tx_count_1h", "n1"), ("null_amount_vs_sender_avg", "nr"),
    ("min_rows", "CASE WHEN total < 6000000 THEN 1 ELSE 0 END")]), "gold"))
def gate_gold(spark, sf):
    return Q.gate_gold(ledger(spark, sf).gold)


@register("gold_profile", with_layers(f"""
SELECT {r4('AVG(rule_score)', 6)} AS avg_rule_score, MAX(rule_score) AS max_rule_score,
       MIN(rule_score) AS min_rule_score, {r4('AVG(sender_tx_count_1h)', 6)} AS avg_tx_1h,
       MAX(sender_tx_count_1h) AS max_tx_1h, COUNT(*) AS total_rows,
       CAST(count_if(is_laundering = 1) AS BIGINT) AS laundering_rows FROM gold""", "gold"))
def gold_profile(spark, sf):
    return Q.gold_profile(ledger(spark, sf).gold)


@register("silver_profile", with_layers(f"""
SELECT COUNT(*) AS total_rows, CAST(count_if(transaction_id IS NULL) AS BIGINT) AS null_transaction_id,
       CAST(count_if(amount IS NULL) AS BIGINT) AS null_amount,
       CAST(count_if(amount < 0) AS BIGINT) AS negative_amount,
       COUNT(*) - COUNT(DISTINCT transaction_id) - CASE WHEN count_if(transaction_id IS NULL) > 0 THEN 1 ELSE 0 END
         AS duplicate_transaction_id,
       {r4('AVG(is_laundering) * 100')} AS laundering_rate_pct,
       count_if(transaction_id IS NULL) = 0 AND count_if(amount IS NULL) = 0 AND count_if(amount < 0) = 0 AS is_valid
FROM std""", "silver"))
def silver_profile(spark, sf):
    return Q.silver_profile(ledger(spark, sf).standardized)


FMT_LIST = ", ".join(f"'{x}'" for x in S.PAYMENT_FORMATS)


@register("rules_bronze", with_layers(f"""
, a AS (SELECT count_if("Amount Paid" < 0 OR "Amount Received" < 0) AS neg,
   count_if("Is Laundering" NOT IN (0, 1) OR "Is Laundering" IS NULL) AS lab,
   count_if(try_strptime("Timestamp", '%Y-%m-%d %H:%M:%S') IS NULL) AS ts,
   count_if("From Bank" IS NULL OR "To Bank" IS NULL) AS bank,
   count_if("Payment Format" NOT IN ({FMT_LIST}) OR "Payment Format" IS NULL) AS fmt FROM bronze)
""".replace("\n, a AS", ",\na AS") + _rule_rows([
    ("amounts_non_negative", "neg"), ("label_binary", "lab"), ("timestamp_parseable", "ts"),
    ("bank_not_null", "bank"), ("payment_format_valid", "fmt")]), "bronze"))
def rules_bronze(spark, sf):
    return Q.rules_bronze(ledger(spark, sf).bronze)


@register("rules_silver", with_layers("""
, ids AS (SELECT transaction_id, COUNT(*) AS c,
   count_if(NOT regexp_matches(sender_account_masked, '^\\*{4}[A-Z0-9]{4}$')
            OR NOT regexp_matches(receiver_account_masked, '^\\*{4}[A-Z0-9]{4}$')) AS m,
   count_if(NOT (amount > 0) OR amount IS NULL) AS am, count_if(is_laundering = 1) AS pos
   FROM silver GROUP BY transaction_id),
a AS (SELECT SUM(c) AS n, SUM(m) AS m, SUM(am) AS am, SUM(pos) AS pos, count_if(c > 1) AS dup FROM ids)
""".replace("\n, ids AS", ",\nids AS") + _rule_rows([
    ("mask_format", "m"), ("amount_positive", "am"),
    ("label_rate_in_range", "CASE WHEN CAST(pos AS DOUBLE) / NULLIF(CAST(n AS DOUBLE), 0) BETWEEN 0 AND 0.1 "
     "THEN 0 ELSE 1 END"),
    ("unique_transaction_id", "dup")]), "silver"))
def rules_silver(spark, sf):
    return Q.rules_silver(ledger(spark, sf).silver)


GOLD_FLAG_BAD = " OR ".join(f"{f} NOT IN (0, 1) OR {f} IS NULL" for f in Q.GOLD_FLAGS)
NUM_BAD = " OR ".join(f"{f} IS NULL OR isnan(CAST({f} AS DOUBLE)) OR isinf(CAST({f} AS DOUBLE))"
                      for f in S.FEATURES)


@register("rules_gold", with_layers(f"""
, a AS (SELECT
   count_if(NOT (round(amount_log, 4) = round(ln(1 + greatest(amount, 0)), 4))
            OR (round(amount_log, 4) = round(ln(1 + greatest(amount, 0)), 4)) IS NULL) AS lg,
   count_if(NOT (tx_hour BETWEEN 0 AND 23)) AS hr, count_if(NOT (tx_day_of_week BETWEEN 0 AND 6)) AS dw,
   count_if({GOLD_FLAG_BAD}) AS fl,
   count_if(NOT (rule_score BETWEEN 0 AND 1) OR NOT (payment_type_risk BETWEEN 0 AND 1)) AS rg,
   count_if({NUM_BAD}) AS nm FROM gold)
""".replace("\n, a AS", ",\na AS") + _rule_rows([
    ("amount_log_matches", "lg"), ("tx_hour_range", "hr"), ("tx_day_of_week_range", "dw"),
    ("binary_flags", "fl"), ("score_and_risk_in_unit_range", "rg"), ("features_finite", "nm")]), "gold"))
def rules_gold(spark, sf):
    return Q.rules_gold(ledger(spark, sf).gold)


@register("layer_drift", with_layers("""
, a AS (SELECT (SELECT COUNT(*) FROM silver) AS sn, (SELECT COUNT(*) FROM bronze) AS bn,
   (SELECT AVG(is_laundering) FROM silver) AS sr, (SELECT AVG("Is Laundering") FROM bronze) AS br)
""".replace("\n, a AS", ",\na AS") + _rule_rows([
    ("silver_rows_le_bronze_rows", "CASE WHEN sn <= bn THEN 0 ELSE 1 END"),
    ("label_rate_drift", "CASE WHEN abs(sr - br) < 0.01 THEN 0 ELSE 1 END")]), "silver"))
def layer_drift(spark, sf):
    lg = ledger(spark, sf)
    return Q.layer_drift(lg.bronze, lg.silver)
