"""Explicit schemas and fixed domain values (no schema inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values that must equal the monitored system's for right results ---
# Currency display name -> ISO code (names not listed pass through unchanged).
CURRENCY_CODES = {
    "US Dollar": "USD",
    "Euro": "EUR",
    "Bitcoin": "BTC",
    "Australian Dollar": "AUD",
    "Yuan": "CNY",
    "Rupee": "INR",
    "Ruble": "RUB",
    "UK Pound": "GBP",
    "Canadian Dollar": "CAD",
    "Swiss Franc": "CHF",
    "Brazilian Real": "BRL",
    "Mexico Peso": "MXN",
    "Shekel": "ILS",
    "Saudi Riyal": "SAR",
    "Yen": "JPY",
}
# Payment format -> risk weight (decimal text; any other format gets DEFAULT_TYPE_RISK).
PAYMENT_TYPE_RISK = {
    "ACH": "1.000",
    "Bitcoin": "0.109",
    "Cash": "0.058",
    "Cheque": "0.056",
    "Credit Card": "0.045",
    "Wire": "0.000",
    "Reinvestment": "0.000",
}
DEFAULT_TYPE_RISK = "0.050"
HIGH_RISK_TYPES = ("ACH", "Bitcoin")
PAYMENT_FORMATS = ("ACH", "Wire", "Cash", "Cheque", "Credit Card", "Bitcoin", "Reinvestment")
# Rule-score weights (decimal text) and cap.
RULE_WEIGHTS = {
    "payment_type_risk": "0.30",
    "is_cross_currency": "0.20",
    "is_structuring": "0.25",
    "is_round_amount": "0.10",
    "is_high_risk_type": "0.15",
}
STRUCTURING_LOW, STRUCTURING_HIGH = 9000, 10000
ROUND_AMOUNT_UNIT = 1000
ALERT_PERCENTILE = 0.99
ALERT_STATUSES = ("OPEN", "INVESTIGATING", "CLOSED")
# Risk levels: lower edge -> label, checked top down; below the last edge is LOW.
RISK_LEVEL_EDGES = ((0.90, "CRITICAL"), (0.70, "HIGH"), (0.40, "MEDIUM"))
HISTOGRAM_LABELS = (
    "0-0.1", "0.1-0.2", "0.2-0.3", "0.3-0.4", "0.4-0.5",
    "0.5-0.6", "0.6-0.7", "0.7-0.8", "0.8-0.9", "0.9-1.0",
)
# Time split for the model (inclusive upper ends).
TRAIN_END = "2022-09-07 23:59:59"
VAL_END = "2022-09-09 23:59:59"
DEFAULT_DECISION_THRESHOLD = 0.90
SWEEP_STEPS = 18  # thresholds i/20 for i = 1..18
# Model quality gate.
GATE_MIN_AUC = 0.85
GATE_MIN_RECALL = 0.20
# Contract SLA.
SLA_MAX_DELAY_MINUTES = 60
SLA_MIN_COMPLETENESS_PCT = 99.5
SLA_MAX_ERROR_RATE_PCT = 0.5
# --- end of fixed values ---

SOURCE_IBM = "ibm_aml"
SOURCE_SAML = "saml_d"

# Raw file header (two columns named "Account"); an explicit schema is
# positional, so the names below replace the duplicate header names.
BRONZE_CSV_SCHEMA = T.StructType([
    T.StructField("Timestamp", T.StringType()),
    T.StructField("From Bank", T.StringType()),
    T.StructField("Account_sender", T.StringType()),
    T.StructField("To Bank", T.StringType()),
    T.StructField("Account_receiver", T.StringType()),
    T.StructField("Amount Received", T.DoubleType()),
    T.StructField("Receiving Currency", T.StringType()),
    T.StructField("Amount Paid", T.DoubleType()),
    T.StructField("Payment Currency", T.StringType()),
    T.StructField("Payment Format", T.StringType()),
    T.StructField("Is Laundering", T.IntegerType()),
])

BRONZE_REQUIRED = (
    "Timestamp", "From Bank", "Account_sender", "To Bank", "Account_receiver",
    "Amount Paid", "Is Laundering", "source",
)

SAML_CSV_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("from_bank", T.StringType()),
    T.StructField("from_account", T.StringType()),
    T.StructField("to_bank", T.StringType()),
    T.StructField("to_account", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("payment_type", T.StringType()),
    T.StructField("is_laundering", T.IntegerType()),
    T.StructField("typology", T.StringType()),
])

SILVER_COLUMNS = (
    "transaction_id", "timestamp", "sender_account_masked", "receiver_account_masked",
    "sender_bank", "receiver_bank", "amount", "amount_log", "payment_currency",
    "receiving_currency", "payment_type", "is_laundering", "typology", "source",
    "tx_hour", "tx_day_of_week", "is_weekend", "is_cross_currency", "ingested_at",
)

GOLD_EXTRA_COLUMNS = (
    "sender_tx_count_1h", "sender_amount_sum_1h", "sender_avg_amount",
    "payment_type_risk", "is_high_risk_type", "is_structuring", "is_round_amount",
    "amount_vs_sender_avg", "rule_score",
)
GOLD_COLUMNS = SILVER_COLUMNS + GOLD_EXTRA_COLUMNS

# Model inputs, in order.
FEATURES = (
    "amount", "amount_log", "tx_hour", "tx_day_of_week", "is_weekend",
    "is_cross_currency", "sender_tx_count_1h", "sender_amount_sum_1h",
    "sender_avg_amount", "amount_vs_sender_avg", "payment_type_risk",
    "is_high_risk_type", "is_structuring", "is_round_amount", "rule_score",
)
TARGET = "is_laundering"

UNIFIED_COLUMNS = (
    "transaction_id", "timestamp", "sender_account", "receiver_account", "sender_bank",
    "receiver_bank", "amount", "payment_currency", "receiving_currency", "payment_type",
    "is_laundering", "typology", "source",
)

AUDIT_SCHEMA = T.StructType([
    T.StructField("dag_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("task_id", T.StringType()),
    T.StructField("layer", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_processed", T.LongType()),
    T.StructField("rows_dead_letter", T.LongType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("laundering_rate", T.DoubleType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

STATUS_CHANGE_SCHEMA = T.StructType([
    T.StructField("alert_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("changed_at", T.TimestampNTZType()),
])
