"""Rule features, the rule score and the alert typology.

Weights and risks are decimal literals so the score is exact; it is cast to
double once at the end (equal scores stay equal, so a ``>=`` cut never splits
a tie group).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txwatch import schemas as S
from txwatch.functions.columns import col


def _sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def payment_type_risk_expr(payment_type: str = "payment_type") -> str:
    arms = " ".join(
        f"WHEN {_sql_str(k)} THEN {v}" for k, v in S.PAYMENT_TYPE_RISK.items()
    )
    return f"CASE `{payment_type}` {arms} ELSE {S.DEFAULT_TYPE_RISK} END"


def payment_type_risk_decimal(payment_type: str = "payment_type") -> Column:
    return F.expr(payment_type_risk_expr(payment_type))


def is_high_risk_type(payment_type="payment_type") -> Column:
    return col(payment_type).isin(*S.HIGH_RISK_TYPES).cast("bigint")


def is_structuring(amount="amount") -> Column:
    a = col(amount)
    return ((a >= S.STRUCTURING_LOW) & (a < S.STRUCTURING_HIGH)).cast("bigint")


def is_round_amount(amount="amount") -> Column:
    """Integer part (half-even rounding cast) is a multiple of 1000, amount > 0."""
    a = col(amount)
    whole = F.bround(a, 0).cast("bigint")
    return ((whole % S.ROUND_AMOUNT_UNIT == 0) & (a > 0)).cast("bigint")


def rule_score_expr() -> str:
    terms = " + ".join(f"`{c}` * {w}" for c, w in S.RULE_WEIGHTS.items())
    return f"CAST(LEAST({terms}, 1.0) AS DOUBLE)"


def rule_score() -> Column:
    """Needs ``payment_type_risk`` as a decimal column plus the 0/1 flags."""
    return F.expr(rule_score_expr())


def amount_vs_sender_avg(amount="amount", sender_avg="sender_avg_amount") -> Column:
    """At most 1000; null without an amount or an average."""
    known = col(amount).isNotNull() & col(sender_avg).isNotNull()
    return F.when(known, F.least(col(amount) / F.greatest(col(sender_avg), F.lit(0.01)), F.lit(1000.0)))


def typology() -> Column:
    """Ordered rule arms; the first match wins."""
    structuring = F.col("is_structuring") == 1
    count_1h = F.col("sender_tx_count_1h")
    return (
        F.when(structuring & (count_1h > 5), "structuring_rapid")
        .when(structuring, "structuring")
        .when((F.col("is_high_risk_type") == 1) & (F.col("is_cross_currency") == 1),
              "cross_currency_high_risk")
        .when(count_1h > 10, "rapid_movement")
        .when(F.col("amount_vs_sender_avg") > 10, "unusual_amount")
        .when((F.col("is_round_amount") == 1) & (F.col("amount") > 50000), "large_round_amount")
        .otherwise("suspicious_pattern")
    )
