"""Independent SQL (DuckDB dialect) for the correctness gate.

Each query in ``__spark_entry__.queries()`` has a SQL twin here that derives
the same layers from the raw tables with plain SQL (window functions,
ROW_NUMBER dedup, PERCENTILE), so the two engines share no code path.
"""

from __future__ import annotations

import re

from txwatch import schemas as S
from txwatch.sources import testdata as TD


def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def currency_case(c: str) -> str:
    """CASE mapping currency names to codes (unknown names pass through)."""
    arms = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in S.CURRENCY_CODES.items())
    return f"CASE {c} {arms} ELSE {c} END"


PTR = ("CASE payment_type " + " ".join(
    f"WHEN {_q(k)} THEN {v}" for k, v in S.PAYMENT_TYPE_RISK.items())
    + f" ELSE {S.DEFAULT_TYPE_RISK} END")
RUN_TS = TD.DEFAULT_RUN_TS
CREATED_AT = f"TIMESTAMP '{RUN_TS.replace('T', ' ')}'"


def _ledger_rows() -> str:
    secs = "(l_orderkey % 17) * 86400 + (l_orderkey * 7919 + l_partkey * 131 + l_linenumber * 17) % 86400"
    amt = (f"CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CASE WHEN l_partkey % {TD.OUTLIER_EVERY} = 0 "
           "THEN 20 ELSE 1 END AS DOUBLE)")
    amt_bad = (f"CASE WHEN l_orderkey % {TD.BAD_AMOUNT_EVERY} = 0 AND l_linenumber % 2 = 1 THEN NULL "
               f"WHEN l_orderkey % {TD.BAD_AMOUNT_EVERY} = 0 THEN -({amt}) ELSE {amt} END")
    recv = (f"CASE WHEN l_orderkey % {TD.NULL_ACCOUNT_EVERY} = 0 AND l_linenumber = 3 THEN NULL "
            "ELSE lpad(CAST(l_suppkey AS VARCHAR), 9, '0') END")
    return f"""
ldg_j AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_extendedprice,
         l.l_discount, l.l_returnflag, o.o_custkey, c.c_nationkey, s.s_nationkey,
         TIMESTAMP '{TD.LEDGER_START}' + to_seconds({secs}) AS ts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
ldg AS (
  SELECT CASE WHEN l_orderkey % {TD.JUNK_TIME_EVERY} = 0 AND l_linenumber = 2 THEN 'not a time'
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS "Timestamp",
         CAST(c_nationkey AS VARCHAR) AS "From Bank",
         lpad(CAST(CASE WHEN o_custkey % {TD.HOT_SENDER_EVERY} = 0 THEN 0 ELSE o_custkey END AS VARCHAR), 9, '0') AS "Account_sender",
         CAST(s_nationkey AS VARCHAR) AS "To Bank",
         {recv} AS "Account_receiver",
         {amt_bad} AS "Amount Received",
         {_list(TD.CURRENCY_NAMES)}[s_nationkey % 15 + 1] AS "Receiving Currency",
         {amt_bad} AS "Amount Paid",
         {_list(TD.CURRENCY_NAMES)}[c_nationkey % 15 + 1] AS "Payment Currency",
         {_list(TD.FORMAT_BY_LINE)}[l_linenumber % 7 + 1] AS "Payment Format",
         CAST(CASE WHEN l_returnflag = 'R' AND l_discount >= 0.09 THEN 1 ELSE 0 END AS INTEGER) AS "Is Laundering",
         '{RUN_TS}' AS ingested_at, 'ibm_aml' AS source,
         CAST(l_orderkey % {TD.CHUNKS} AS INTEGER) AS chunk_id,
         l_orderkey AS src_orderkey, l_linenumber AS src_linenumber,
         l_partkey AS src_partkey, l_suppkey AS src_suppkey
  FROM ldg_j
),
bronze AS (
  SELECT *, 0 AS copy_no FROM ldg
  UNION ALL
  SELECT * REPLACE (chunk_id + 1 AS chunk_id), 1 AS copy_no FROM ldg
  WHERE src_orderkey % {TD.INTER_COPY_EVERY} = 0
  UNION ALL
  SELECT *, 2 AS copy_no FROM ldg WHERE src_orderkey % {TD.INTRA_COPY_EVERY} = 0
)"""


def _silver() -> str:
    ts = """CAST(try_strptime("Timestamp", '%Y-%m-%d %H:%M:%S') AS TIMESTAMP)"""
    return f"""
bronze_flag AS (
  SELECT *, ("Amount Paid" IS NULL OR "Amount Paid" < 0 OR "Account_sender" IS NULL
             OR "Account_receiver" IS NULL OR {ts} IS NULL) AS is_bad
  FROM bronze
),
clean AS (SELECT * EXCLUDE (is_bad) FROM bronze_flag WHERE NOT is_bad),
dead_letter AS (SELECT * EXCLUDE (is_bad) FROM bronze_flag WHERE is_bad),
std0 AS (
  SELECT md5(concat_ws('_', source, "Timestamp", "Account_sender", "Account_receiver",
             CAST(CAST("Amount Paid" AS DECIMAL(18,2)) AS VARCHAR), "Payment Format")) AS transaction_id,
         {ts} AS timestamp,
         '****' || right("Account_sender", 4) AS sender_account_masked,
         '****' || right("Account_receiver", 4) AS receiver_account_masked,
         "From Bank" AS sender_bank, "To Bank" AS receiver_bank,
         CAST("Amount Paid" AS DOUBLE) AS amount,
         {currency_case('"Payment Currency"')} AS payment_currency,
         {currency_case('"Receiving Currency"')} AS receiving_currency,
         "Payment Format" AS payment_type,
         CAST("Is Laundering" AS BIGINT) AS is_laundering,
         CAST(NULL AS VARCHAR) AS typology, source, ingested_at,
         chunk_id, src_orderkey, src_linenumber, src_partkey, src_suppkey, copy_no
  FROM clean
),
std AS (
  SELECT *, ln(1 + greatest(amount, 0)) AS amount_log,
         CAST(hour(timestamp) AS BIGINT) AS tx_hour,
         CAST(isodow(timestamp) - 1 AS BIGINT) AS tx_day_of_week,
         CAST(isodow(timestamp) - 1 IN (5, 6) AS BIGINT) AS is_weekend,
         CAST(coalesce(payment_currency <> receiving_currency, true) AS BIGINT) AS is_cross_currency
  FROM std0
),
marked AS (
  SELECT *,
    CASE WHEN ROW_NUMBER() OVER (PARTITION BY transaction_id, chunk_id
           ORDER BY src_orderkey, src_linenumber, src_partkey, src_suppkey, copy_no) > 1
         THEN 'intra_chunk_duplicate'
         WHEN chunk_id > MIN(chunk_id) OVER (PARTITION BY transaction_id)
         THEN 'inter_chunk_duplicate' END AS dead_reason
  FROM std
),
silver AS (
  SELECT {", ".join(S.SILVER_COLUMNS)} FROM marked WHERE dead_reason IS NULL
),
silver_dead AS (SELECT * FROM marked WHERE dead_reason IS NOT NULL)"""


def _gold() -> str:
    terms = " + ".join(f"{c} * {w}" for c, w in S.RULE_WEIGHTS.items())
    return f"""
gold0 AS (
  SELECT s.*,
    COUNT(*) OVER w1 AS sender_tx_count_1h,
    CAST(SUM(CAST(amount AS DECIMAL(24,6))) OVER w1 AS DOUBLE) AS sender_amount_sum_1h,
    CAST(SUM(CAST(amount AS DECIMAL(24,6))) OVER ws AS DOUBLE)
      / CAST(COUNT(amount) OVER ws AS DOUBLE) AS sender_avg_amount,
    {PTR} AS payment_type_risk,
    CAST(payment_type IN ('ACH', 'Bitcoin') AS BIGINT) AS is_high_risk_type,
    CAST(amount >= 9000 AND amount < 10000 AS BIGINT) AS is_structuring,
    CAST(CAST(amount AS BIGINT) % 1000 = 0 AND amount > 0 AS BIGINT) AS is_round_amount
  FROM silver s
  WINDOW w1 AS (PARTITION BY sender_account_masked ORDER BY timestamp
                RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW),
         ws AS (PARTITION BY sender_account_masked)
),
gold AS (
  SELECT {", ".join(S.SILVER_COLUMNS)}, sender_tx_count_1h, sender_amount_sum_1h,
    sender_avg_amount, CAST(payment_type_risk AS DOUBLE) AS payment_type_risk,
    is_high_risk_type, is_structuring, is_round_amount,
    LEAST(amount / GREATEST(sender_avg_amount, 0.01), 1000.0) AS amount_vs_sender_avg,
    CAST(LEAST({terms}, 1.0) AS DOUBLE) AS rule_score
  FROM gold0
)"""


TYPOLOGY = """CASE
      WHEN is_structuring = 1 AND sender_tx_count_1h > 5 THEN 'structuring_rapid'
      WHEN is_structuring = 1 THEN 'structuring'
      WHEN is_high_risk_type = 1 AND is_cross_currency = 1 THEN 'cross_currency_high_risk'
      WHEN sender_tx_count_1h > 10 THEN 'rapid_movement'
      WHEN amount_vs_sender_avg > 10 THEN 'unusual_amount'
      WHEN is_round_amount = 1 AND amount > 50000 THEN 'large_round_amount'
      ELSE 'suspicious_pattern' END"""


def _cut() -> str:
    return f"""
ranked AS (SELECT rule_score, row_number() OVER (ORDER BY rule_score) - 1 AS i,
           CAST(count(*) OVER () - 1 AS DOUBLE) * {S.ALERT_PERCENTILE} AS p FROM gold),
cut AS (SELECT CASE WHEN min(rule_score) = max(rule_score) THEN min(rule_score)
        ELSE (ceil(any_value(p)) - any_value(p)) * min(rule_score)
             + (any_value(p) - floor(any_value(p))) * max(rule_score) END AS exact
        FROM ranked WHERE i = floor(p) OR i = ceil(p)),
hits AS (
  SELECT md5(transaction_id || '{RUN_TS}') AS alert_id, *, {TYPOLOGY} AS hit_typology
  FROM gold WHERE rule_score >= (SELECT exact FROM cut)
)"""


def _alerts() -> str:
    return f"""
thr AS (SELECT round(exact, 6) AS threshold FROM cut),
alerts AS (
  SELECT md5(transaction_id || '{RUN_TS}') AS alert_id, transaction_id,
         rule_score AS risk_score, {TYPOLOGY} AS typology, 'OPEN' AS status,
         {CREATED_AT} AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at
  FROM gold WHERE rule_score >= (SELECT exact FROM cut)
),
changes AS (
  SELECT alert_id, 'investigating' AS status, created_at + INTERVAL 1 HOUR AS changed_at
    FROM alerts WHERE substr(alert_id, 1, 1) IN ('0', '1', '2', '3', '4')
  UNION ALL
  SELECT alert_id, 'CLOSED', created_at + INTERVAL 2 HOUR
    FROM alerts WHERE substr(alert_id, 1, 1) IN ('4', '5')
  UNION ALL
  SELECT alert_id, 'ESCALATED', created_at + INTERVAL 1 HOUR
    FROM alerts WHERE substr(alert_id, 1, 1) = 'a'
  UNION ALL
  SELECT 'missing-' || alert_id, 'CLOSED', created_at + INTERVAL 1 HOUR
    FROM alerts WHERE substr(alert_id, 1, 1) = 'b'
),
changes_n AS (SELECT alert_id, upper(trim(status)) AS status, changed_at FROM changes),
changes_ok AS (
  SELECT * FROM changes_n WHERE status IN ('OPEN', 'INVESTIGATING', 'CLOSED')
    AND alert_id IN (SELECT alert_id FROM alerts)
),
latest AS (
  SELECT alert_id, arg_max(status, (changed_at, status)) AS l_status, max(changed_at) AS l_at
  FROM changes_ok GROUP BY alert_id
),
alerts_cur AS (
  SELECT a.alert_id, a.transaction_id, a.risk_score, a.typology,
         coalesce(l.l_status, a.status) AS status, a.created_at,
         coalesce(l.l_at, a.updated_at) AS updated_at
  FROM alerts a LEFT JOIN latest l ON a.alert_id = l.alert_id
),
rejected AS (
  SELECT alert_id, status, changed_at, 'invalid_status' AS reason FROM changes_n
    WHERE status IS NULL OR status NOT IN ('OPEN', 'INVESTIGATING', 'CLOSED')
  UNION ALL
  SELECT alert_id, status, changed_at, 'alert_not_found' FROM changes_n
    WHERE status IN ('OPEN', 'INVESTIGATING', 'CLOSED')
      AND NOT EXISTS (SELECT 1 FROM alerts a WHERE a.alert_id = changes_n.alert_id)
),
scores AS (
  SELECT transaction_id, rule_score AS ml_probability, rule_score AS final_risk_score FROM gold
)"""


#: An alert's status from the rule that makes the change log (the later change wins), without the log's joins.
STATUS_NOW = ("CASE WHEN substr(alert_id, 1, 1) IN ('0', '1', '2', '3') THEN 'INVESTIGATING' "
              "WHEN substr(alert_id, 1, 1) IN ('4', '5') THEN 'CLOSED' ELSE 'OPEN' END")
CHANGED_NOW = (f"CASE WHEN substr(alert_id, 1, 1) IN ('0', '1', '2', '3') THEN {CREATED_AT} + INTERVAL 1 HOUR "
               f"WHEN substr(alert_id, 1, 1) IN ('4', '5') THEN {CREATED_AT} + INTERVAL 2 HOUR END")


def with_layers(body: str, upto: str = "alerts") -> str:
    """Prefix ``body`` with the CTE chain up to the named layer."""
    parts = [_ledger_rows()]
    if upto in ("silver", "gold", "hits", "alerts"):
        parts.append(_silver())
    if upto in ("gold", "hits", "alerts"):
        parts.append(_gold())
    if upto in ("hits", "alerts"):
        parts.append(_cut())
    if upto == "alerts":
        parts.append(_alerts())
    # layers that several places read are built once
    text = ",".join(parts)
    for layer in ("bronze", "std", "marked", "gold", "alerts"):
        text = re.sub(rf"(?m)^{layer} AS \(", f"{layer} AS MATERIALIZED (", text)
    return "WITH " + text + "\n" + body
