"""Ingest variants, long windows, unified sources, contract rules, sinks,
model and streaming queries."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from txwatch import schemas as S
from txwatch.functions import columns as C
from txwatch.operators import features as FE
from txwatch.operators import ingest as I
from txwatch.operators import ml as ML
from txwatch.operators import quality as Q
from txwatch.operators import standardize as ST
from txwatch.oracle import RUN_TS, with_layers
from txwatch.oracle import currency_case as CUR
from txwatch.plans import publish as P
from txwatch.plans.catalog import register
from txwatch.plans.pipeline import ledger
from txwatch.session import scratch_path, session_key
from txwatch.sources import testdata as TD
from txwatch.streaming import streams as SS


def _cte(body: str, upto: str) -> str:
    """``body`` starts with extra CTEs (", name AS (...)")."""
    return with_layers(body, upto).replace("\n, ", ",\n", 1)


ID_TEXT = """CAST(CAST("Amount Paid" AS DECIMAL(18,2)) AS VARCHAR)"""


@register("transaction_id_variants", with_layers(f"""
SELECT "Timestamp", "Account_sender", "Account_receiver",
  md5(concat_ws('_', source, "Timestamp", "Account_sender", "Account_receiver", {ID_TEXT})) AS id_without_format,
  md5(concat_ws('_', source, "Timestamp", "Account_sender", "Account_receiver", {ID_TEXT}, "Payment Format"))
    AS id_with_format
FROM clean""", "silver"))
def transaction_id_variants(spark, sf):
    c = ledger(spark, sf).clean
    args = ("source", "Timestamp", "Account_sender", "Account_receiver", "Amount Paid")
    return c.select("Timestamp", "Account_sender", "Account_receiver",
                    C.transaction_id(*args).alias("id_without_format"),
                    C.transaction_id(*args, "Payment Format").alias("id_with_format"))


@register("currency_codes", with_layers("""
SELECT "Payment Currency" AS currency_name, payment_currency AS currency_code, COUNT(*) AS tx_count
FROM (SELECT "Payment Currency", """ + CUR('"Payment Currency"') + """ AS payment_currency FROM clean)
GROUP BY 1, 2""", "silver"))
def currency_codes(spark, sf):
    c = ledger(spark, sf).clean
    return (c.select(F.col("Payment Currency").alias("currency_name"),
                     C.currency_code("Payment Currency").alias("currency_code"))
            .groupBy("currency_name", "currency_code").agg(F.count(F.lit(1)).alias("tx_count")))


CAL = ("transaction_id", "timestamp", "tx_hour", "tx_day_of_week", "is_weekend",
       "is_cross_currency", "amount_log")


@register("calendar_features", with_layers(f"SELECT {', '.join(CAL)} FROM silver", "silver"))
def calendar_features(spark, sf):
    return ledger(spark, sf).silver.select(*CAL)


TB_SQL = """CASE WHEN hour(timestamp) >= 6 AND hour(timestamp) < 12 THEN 'morning'
  WHEN hour(timestamp) >= 12 AND hour(timestamp) < 18 THEN 'afternoon'
  WHEN hour(timestamp) >= 18 AND hour(timestamp) < 22 THEN 'evening' ELSE 'night' END"""


@register("time_bucket_counts", with_layers(
    f"SELECT {TB_SQL} AS time_bucket, COUNT(*) AS tx_count FROM silver GROUP BY 1", "silver"))
def time_bucket_counts(spark, sf):
    s = ledger(spark, sf).silver
    return s.groupBy(C.time_bucket("timestamp").alias("time_bucket")).agg(
        F.count(F.lit(1)).alias("tx_count"))


EVT_PAY = """evp AS (SELECT md5('evt_' || CAST(event_id AS VARCHAR)) AS transaction_id, ts AS timestamp,
  '****' || right(lpad(CAST(user_id AS VARCHAR), 9, '0'), 4) AS sender_account_masked,
  event_type AS payment_type, value AS amount FROM events)"""


def _zscore_sql(src: str) -> str:
    return f"""zs AS (SELECT payment_type, AVG(amount) AS mu, stddev_samp(amount) AS sd FROM {src} GROUP BY 1),
z AS (SELECT e.*, CAST(round(CAST(CASE WHEN zs.sd > 0 THEN (e.amount - zs.mu) / zs.sd ELSE 0.0 END
  AS DECIMAL(38,12)), 6) AS DOUBLE) AS amount_zscore FROM {src} e LEFT JOIN zs ON e.payment_type = zs.payment_type)"""


def _events_sql(body: str) -> str:
    return "WITH " + EVT_PAY + ",\n" + body


@register("long_window_features", _events_sql(_zscore_sql("evp") + f""",
lw AS (SELECT *, CAST(floor(epoch_us(timestamp) / 1000000) AS BIGINT) AS ts_unix FROM z)
SELECT transaction_id, {TB_SQL} AS time_bucket,
  COUNT(transaction_id) OVER (PARTITION BY sender_account_masked ORDER BY ts_unix
    RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) AS rolling_7d_tx_count,
  COUNT(transaction_id) OVER (PARTITION BY sender_account_masked ORDER BY ts_unix
    RANGE BETWEEN 2592000 PRECEDING AND CURRENT ROW) AS rolling_30d_tx_count,
  amount_zscore FROM lw"""))
def long_window_features(spark, sf):
    """7d/30d trailing counts, time bucket and per-type z-score on events
    (sender = user); the five columns of the feature sink."""
    ev = TD.events_payments(spark, sf)
    z = FE.amount_zscore(ev).withColumn("amount_zscore", C.round_half_up("amount_zscore", 6))
    lw = FE.long_window_features(z)
    return lw.select("transaction_id", "time_bucket", "rolling_7d_tx_count",
                     "rolling_30d_tx_count", "amount_zscore")


@register("amount_zscore", _events_sql(_zscore_sql("evp") + """
SELECT transaction_id, payment_type, amount, amount_zscore FROM z"""))
def amount_zscore(spark, sf):
    ev = TD.events_payments(spark, sf)
    z = FE.amount_zscore(ev)
    return z.select("transaction_id", "payment_type", "amount",
                    C.round_half_up("amount_zscore", 6).alias("amount_zscore"))


SAML_SQL = """saml AS (SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, 'EVT' AS from_bank,
  lpad(CAST(user_id AS VARCHAR), 9, '0') AS from_account, 'EVT' AS to_bank,
  lpad(coalesce(json_extract_string(props, '$.k'), '0'), 9, '0') AS to_account,
  value AS amount, 'US Dollar' AS currency, event_type AS payment_type,
  CAST(event_type = 'error' AS INTEGER) AS is_laundering,
  CASE WHEN event_type = 'error' THEN 'error_burst' END AS typology FROM events)"""
UNIFIED_SQL = f""", {SAML_SQL},
unified AS (
  SELECT md5(concat_ws('_', 'ibm_aml', "Timestamp", "Account_sender", "Account_receiver", {ID_TEXT},
             "Payment Format")) AS transaction_id,
    CAST(try_strptime("Timestamp", '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS timestamp,
    "Account_sender" AS sender_account, "Account_receiver" AS receiver_account,
    "From Bank" AS sender_bank, "To Bank" AS receiver_bank, "Amount Paid" AS amount,
    {CUR('"Payment Currency"')} AS payment_currency, {CUR('"Receiving Currency"')} AS receiving_currency,
    "Payment Format" AS payment_type, CAST("Is Laundering" AS BIGINT) AS is_laundering,
    CAST(NULL AS VARCHAR) AS typology, 'ibm_aml' AS source FROM clean
  UNION ALL
  SELECT md5(concat_ws('_', 'saml_d', timestamp, from_account, to_account,
             CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR), payment_type)),
    CAST(strptime(timestamp, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP), from_account, to_account,
    from_bank, to_bank, amount, {CUR('currency')}, {CUR('currency')}, payment_type,
    CAST(is_laundering AS BIGINT), typology, 'saml_d' FROM saml)"""


def _unified(spark, sf):
    ibm = ST.to_unified(ledger(spark, sf).clean, S.SOURCE_IBM)
    saml = ST.to_unified(TD.saml_source(spark, sf), S.SOURCE_SAML)
    return ST.union_sources(ibm, saml)


@register("unified_union", _cte(UNIFIED_SQL + "\nSELECT * FROM unified", "silver"))
def unified_union(spark, sf):
    return _unified(spark, sf)


CODES = ", ".join(f"'{c}'" for c in S.CURRENCY_CODES.values())
REQ_NULL = " OR ".join(f"{c} IS NULL" for c in S.UNIFIED_COLUMNS if c != "typology")


@register("contract_rules", _cte(UNIFIED_SQL + f""",
ids AS (SELECT transaction_id, COUNT(*) AS c, count_if({REQ_NULL}) AS nl, count_if(amount < 0) AS ng,
  count_if(payment_currency NOT IN ({CODES}) OR receiving_currency NOT IN ({CODES})) AS cu,
  count_if(timestamp > TIMESTAMP '{RUN_TS.replace("T", " ")}') AS fu FROM unified GROUP BY transaction_id),
a AS (SELECT SUM(nl) AS nl, SUM(ng) AS ng, SUM(cu) AS cu, SUM(fu) AS fu, count_if(c > 1) AS dup FROM ids)
""" + " UNION ALL ".join(
    f"SELECT '{n}' AS rule, CAST(coalesce({v}, 0) AS BIGINT) AS violations, coalesce({v}, 0) = 0 AS passed FROM a"
    for n, v in [("no_null_in_required_fields", "nl"), ("amount_positive", "ng"),
                 ("valid_currency_codes", "cu"), ("timestamp_not_future", "fu"),
                 ("no_duplicate_transaction_id", "dup")]), "silver"))
def contract_rules(spark, sf):
    return Q.contract_rules(_unified(spark, sf), RUN_TS)


@register("contract_sla", with_layers(f"""
, b AS (SELECT COUNT(*) AS total, max(date_diff('second',
          CAST(try_strptime("Timestamp", '%Y-%m-%d %H:%M:%S') AS TIMESTAMP), CAST(ingested_at AS TIMESTAMP)) / 60.0) AS delay
        FROM bronze),
c AS (SELECT COUNT(*) AS ok FROM clean),
m AS (SELECT delay, coalesce(CAST(round(CAST(CAST(ok AS DOUBLE) / NULLIF(CAST(total AS DOUBLE), 0) * 100
        AS DECIMAL(38,12)), 4) AS DOUBLE), 0.0) AS cp,
      coalesce(CAST(round(CAST(CAST(total - ok AS DOUBLE) / NULLIF(CAST(total AS DOUBLE), 0) * 100
        AS DECIMAL(38,12)), 4) AS DOUBLE), 0.0) AS er FROM b, c)
SELECT CAST(round(CAST(delay AS DECIMAL(38,12)), 4) AS DOUBLE) AS max_ingestion_delay_minutes,
  cp AS completeness_pct, er AS error_rate_pct, delay <= {S.SLA_MAX_DELAY_MINUTES} AS delay_ok,
  cp >= {S.SLA_MIN_COMPLETENESS_PCT} AS completeness_ok, er <= {S.SLA_MAX_ERROR_RATE_PCT} AS error_rate_ok
FROM m""".replace("\n, b AS", ",\nb AS"), "silver"))
def contract_sla(spark, sf):
    lg = ledger(spark, sf)
    return Q.contract_sla(lg.bronze, lg.clean)


INC = ", ".join(("transaction_id", "chunk_id", "copy_no"))


@register("incremental_new_rows", with_layers(f"""
SELECT {INC} FROM (SELECT {INC}, MIN(chunk_id) OVER (PARTITION BY transaction_id) AS first_chunk FROM std)
WHERE chunk_id >= 3 AND first_chunk > 2""", "silver"))
def incremental_new_rows(spark, sf):
    lg = ledger(spark, sf)
    published = lg._dedup.where(F.col("dead_reason").isNull() & (F.col("chunk_id") <= 2))
    new = lg.standardized.where(F.col("chunk_id") >= 3)
    return ST.incremental_split(new, published)[0].select("transaction_id", "chunk_id", "copy_no")


@register("incremental_seen_rows", with_layers(f"""
SELECT {INC} FROM (SELECT {INC}, MIN(chunk_id) OVER (PARTITION BY transaction_id) AS first_chunk FROM std)
WHERE chunk_id >= 3 AND first_chunk <= 2""", "silver"))
def incremental_seen_rows(spark, sf):
    lg = ledger(spark, sf)
    published = lg._dedup.where(F.col("dead_reason").isNull() & (F.col("chunk_id") <= 2))
    new = lg.standardized.where(F.col("chunk_id") >= 3)
    return ST.incremental_split(new, published)[1].select("transaction_id", "chunk_id", "copy_no")


RAW_COLS = [f.name for f in S.BRONZE_CSV_SCHEMA.fields]


@register("bronze_csv_roundtrip", with_layers(
    "SELECT " + ", ".join(f'"{c}"' for c in RAW_COLS) + " FROM bronze", "bronze"))
def bronze_csv_roundtrip(spark, sf):
    """Write raw rows as CSV with the source header (two columns named
    "Account") and read them back with the positional schema."""
    b = ledger(spark, sf).bronze
    header = ["Timestamp", "From Bank", "Account", "To Bank", "Account", "Amount Received",
              "Receiving Currency", "Amount Paid", "Payment Currency", "Payment Format",
              "Is Laundering"]
    path = scratch_path(spark, "bronze-csv")
    raw = b.select(*[F.col(c) for c in RAW_COLS]).toDF(*header)
    raw.write.option("header", True).csv(path)
    return spark.read.schema(S.BRONZE_CSV_SCHEMA).option("header", True).csv(path)


@register("sample_fraction", with_layers(f"""
SELECT {', '.join(S.SILVER_COLUMNS)} FROM silver
WHERE CAST('0x' || substr(md5('42' || transaction_id), 1, 13) AS BIGINT) < {int(0.15 * (1 << 52))}""", "silver"))
def sample_fraction(spark, sf):
    """Bernoulli sample of silver (fraction 0.15, seed 42), reproducible by
    transaction id."""
    return I.sample_rows(ledger(spark, sf).silver, 0.15, seed=42, key="transaction_id")


@register("gate_bronze", with_layers("""
SELECT c AS "column", true AS present, (SELECT COUNT(*) FROM bronze) AS row_count
FROM (VALUES """ + ", ".join(f"('{c}')" for c in S.BRONZE_REQUIRED) + """) v(c)""", "bronze"))
def gate_bronze(spark, sf):
    return Q.gate_bronze(ledger(spark, sf).bronze)


AUDIT_STABLE = ("dag_id", "run_id", "task_id", "layer", "status", "rows_processed", "rows_dead_letter",
                "laundering_rate", "error_message")


@register("audit_rows", with_layers(f"""
SELECT 'silver' AS dag_id, '{RUN_TS}' AS run_id, 'build_silver' AS task_id, 'silver' AS layer,
       'success' AS status, COUNT(*) AS rows_processed,
       (SELECT COUNT(*) FROM silver_dead) + (SELECT COUNT(*) FROM dead_letter) AS rows_dead_letter,
       CAST(SUM(is_laundering) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100 AS laundering_rate,
       CAST(NULL AS VARCHAR) AS error_message FROM silver
UNION ALL
SELECT 'gold', '{RUN_TS}', 'build_gold', 'gold', 'success', COUNT(*), 0,
       CAST(SUM(is_laundering) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100, NULL FROM gold""", "gold"))
def audit_rows(spark, sf):
    """Write silver and gold with counts observed in the same pass; one audit
    row per task (without the run's own times)."""
    lg = ledger(spark, sf)
    root = scratch_path(spark, "audit")
    rows = []
    t0 = time.time()
    m = P.observed_write(lg.silver, f"{root}/silver")
    dead = lg.silver_dead.count() + lg.dead_letter.count()
    rows.append(P.audit_row(spark, "silver", RUN_TS, "build_silver", "silver", "success",
                            m["rows"], dead, t0, m.get("positives")))
    t1 = time.time()
    m = P.observed_write(lg.gold, f"{root}/gold")
    rows.append(P.audit_row(spark, "gold", RUN_TS, "build_gold", "gold", "success",
                            m["rows"], 0, t1, m.get("positives")))
    out = rows[0].unionByName(rows[1])
    P.append_audit(out, f"{root}/audit")
    return spark.read.parquet(f"{root}/audit").select(*AUDIT_STABLE)


_MODELS: dict = {}


def _model(spark, sf):
    key = (session_key(spark), sf)
    if key not in _MODELS:
        ds = ML.ml_dataset(ledger(spark, sf).gold)
        _MODELS[key] = ML.train(ds)
    return _MODELS[key]


@register("model_scores")
def model_scores(spark, sf):
    """Boosted trees fitted on train (val for early stopping), scoring every
    gold row."""
    ds = ML.ml_dataset(ledger(spark, sf).gold)
    return ML.score(_model(spark, sf), ds)


@register("model_evaluation")
def model_evaluation(spark, sf):
    """Val/test AUC, AP and threshold metrics of the fitted model."""
    ds = ML.ml_dataset(ledger(spark, sf).gold)
    return ML.evaluate(_model(spark, sf), ds)


@register("feature_importance")
def feature_importance(spark, sf):
    return ML.feature_importance(_model(spark, sf))


@register("permutation_importance")
def permutation_importance(spark, sf):
    """AUC drop per permuted feature on the val and test rows."""
    ds = ML.ml_dataset(ledger(spark, sf).gold)
    return ML.permutation_importance(_model(spark, sf), ds)


STREAM_SQL = """SELECT md5('evt_' || CAST(event_id AS VARCHAR)) AS transaction_id, ts AS timestamp,
  '****' || right(lpad(CAST(user_id AS VARCHAR), 9, '0'), 4) AS sender_account_masked,
  event_type AS payment_type, value AS amount, CAST(hour(ts) AS BIGINT) AS tx_hour,
  CAST(isodow(ts) - 1 AS BIGINT) AS tx_day_of_week, ln(1 + greatest(value, 0)) AS amount_log{more} FROM events"""
STREAM_BAD = "(value IS NULL OR value < 0 OR user_id IS NULL)"


@register("stream_clean", STREAM_SQL.format(more="") + f" WHERE NOT {STREAM_BAD}")
def stream_clean(spark, sf):
    return SS.stream_clean(spark, sf)


@register("stream_dead", STREAM_SQL.format(more="") + f" WHERE {STREAM_BAD}")
def stream_dead(spark, sf):
    return SS.stream_clean(spark, sf, dead=True)


@register("stream_dedup", STREAM_SQL.format(more="").replace(" FROM events", ", ts AS event_time FROM events"))
def stream_dedup(spark, sf):
    out = SS.stream_dedup(spark, sf)
    return out.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@register("stream_velocity", _events_sql("""
win AS (SELECT e.*, time_bucket(INTERVAL 10 MINUTE, timestamp) - INTERVAL (k * 10) MINUTE AS window_start
        FROM evp e, unnest(range(0, 6)) t(k))
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, sender_account_masked,
  COUNT(*) AS tx_count, CAST(SUM(CAST(amount AS DECIMAL(24,6))) AS DOUBLE) AS amount_sum
FROM win GROUP BY 1, 2, 3
HAVING window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 60 MINUTE"""))
def stream_velocity(spark, sf):
    """Sliding 1h/10min sender windows as a watermarked stream (append mode
    emits the windows that closed before the final watermark)."""
    return SS.stream_velocity(spark, sf)


@register("stream_trailing_velocity", _events_sql("""
SELECT transaction_id, sender_account_masked, timestamp,
  COUNT(*) OVER w AS sender_tx_count_1h,
  CAST(SUM(CAST(amount AS DECIMAL(24,6))) OVER w AS DOUBLE) AS sender_amount_sum_1h
FROM evp
WINDOW w AS (PARTITION BY sender_account_masked ORDER BY timestamp
             RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)"""))
def stream_trailing_velocity(spark, sf):
    """Per-event trailing-hour sender velocity on a stream with keyed state
    (one micro-batch over the available files equals the batch window)."""
    return SS.stream_trailing_velocity(spark, sf)


@register("sender_velocity_tumbling", _events_sql("""
SELECT time_bucket(INTERVAL 1 HOUR, timestamp) AS window_start,
  time_bucket(INTERVAL 1 HOUR, timestamp) + INTERVAL 1 HOUR AS window_end, sender_account_masked,
  COUNT(*) AS tx_count, CAST(SUM(CAST(amount AS DECIMAL(24,6))) AS DOUBLE) AS amount_sum
FROM evp GROUP BY 1, 2, 3"""))
def sender_velocity_tumbling(spark, sf):
    """Tumbling 1h sender windows on events (batch form of the stream)."""
    return SS.sliding_velocity(TD.events_payments(spark, sf), length="1 hour", slide="1 hour")


@register("sender_velocity_sliding", _events_sql("""
win AS (SELECT e.*, time_bucket(INTERVAL 10 MINUTE, timestamp) - INTERVAL (k * 10) MINUTE AS window_start
        FROM evp e, unnest(range(0, 6)) t(k))
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, sender_account_masked,
  COUNT(*) AS tx_count, CAST(SUM(CAST(amount AS DECIMAL(24,6))) AS DOUBLE) AS amount_sum
FROM win GROUP BY 1, 2, 3"""))
def sender_velocity_sliding(spark, sf):
    """Sliding 1h/10min sender windows on events (batch form of the stream)."""
    return SS.sliding_velocity(TD.events_payments(spark, sf))
