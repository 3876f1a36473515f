"""Column expressions (all JVM-side built-ins; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwatch import schemas as S


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask_account(c) -> Column:
    """'****' + last four characters; shorter values are kept whole."""
    return F.concat(F.lit("****"), F.right(col(c).cast("string"), F.lit(4)))


def currency_code(c) -> Column:
    """Display name -> ISO code; names outside the table pass through."""
    pairs = []
    for name, code in S.CURRENCY_CODES.items():
        pairs += [F.lit(name), F.lit(code)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(c)), col(c))


def amount_text(c) -> Column:
    """Stable number text for ids (``1.0E7`` style text differs by engine)."""
    return col(c).cast("decimal(18,2)").cast("string")


def transaction_id(source, ts_text, sender, receiver, amount, payment_format=None) -> Column:
    """md5 hex of ``source_ts_sender_receiver_amount[_format]``."""
    parts = [col(source), col(ts_text), col(sender), col(receiver), amount_text(amount)]
    if payment_format is not None:
        parts.append(col(payment_format))
    return F.md5(F.concat_ws("_", *parts))


#: The forms of a time that raw files may have.
TIME_TEXT = r"^\d{4}[-/]\d{2}[-/]\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?$"


def parse_timestamp(c) -> Column:
    """Timestamp text (``yyyy-MM-dd HH:mm[:ss]`` or with ``/``) ->
    timestamp_ntz, independent of the session time zone; other text, shorter
    forms of a time included, gives null (ANSI-safe)."""
    text = col(c).cast("string")
    parsed = F.regexp_replace(text, "/", "-").try_cast(T.TimestampNTZType())
    return F.when(text.rlike(TIME_TEXT), parsed)


def tx_hour(ts) -> Column:
    return F.hour(col(ts)).cast("bigint")


def tx_day_of_week(ts) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(col(ts)).cast("bigint")


def is_weekend(dow) -> Column:
    return col(dow).isin(5, 6).cast("bigint")


def is_cross_currency(a, b) -> Column:
    """Different currencies; a null on either side counts as different."""
    return F.coalesce(col(a) != col(b), F.lit(True)).cast("bigint")


def amount_log(amount) -> Column:
    """log1p(max(amount, 0)) (correctly rounded, so it equals a correctly
    rounded ``ln(1 + x)`` wherever ``1 + x`` is exact)."""
    return F.log1p(F.greatest(col(amount), F.lit(0.0)))


def time_bucket(ts) -> Column:
    h = F.hour(col(ts))
    return (
        F.when((h >= 6) & (h < 12), "morning")
        .when((h >= 12) & (h < 18), "afternoon")
        .when((h >= 18) & (h < 22), "evening")
        .otherwise("night")
    )


def risk_level(score) -> Column:
    s = col(score)
    out = F.when(s.isNull(), F.lit("UNKNOWN"))
    for edge, label in S.RISK_LEVEL_EDGES:
        out = out.when(s >= F.lit(edge), F.lit(label))
    return out.otherwise(F.lit("LOW"))


def histogram_bin(score) -> Column:
    """min(int(score * 10), 9) as an int bin index."""
    return F.least(F.floor(col(score) * 10), F.lit(9)).cast("int")


def histogram_label(bin_col) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in S.HISTOGRAM_LABELS]), col(bin_col) + 1)


def pct(num, den, scale: int = 4) -> Column:
    """Percentage rounded half-up through decimal; 0 when the base is 0."""
    ratio = F.try_divide(col(num).cast("double"), col(den).cast("double")) * 100
    return F.coalesce(F.round(ratio.cast("decimal(38,12)"), scale).cast("double"), F.lit(0.0))


def round_half_up(c, scale: int) -> Column:
    """Half-away-from-zero rounding through decimal, returned as double."""
    return F.round(col(c).cast("decimal(38,12)"), scale).cast("double")


def epoch_micros(c, dtype: T.DataType) -> Column:
    """Microseconds since 1970-01-01 for timestamp or timestamp_ntz, TZ-free."""
    if isinstance(dtype, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())
        return F.timestamp_diff("MICROSECOND", epoch, col(c))
    return F.unix_micros(col(c))
