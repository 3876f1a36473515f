"""Gold layer: sender velocity windows, sender baseline, rule features,
long windows and per-type z-scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch import schemas as S
from txwatch.functions import columns as C
from txwatch.functions import rules as R
from txwatch.operators import standardize as ST
from txwatch.operators.sliding import auto_block_seconds, sliding_sums

HOUR = 3600
DAY = 86400
# Money sums run in decimal so they are exact and order-independent.
MONEY = "decimal(24,6)"


def sender_velocity(df: DataFrame, sender: str = "sender_account_masked",
                    ts: str = "timestamp", frame_seconds: int = HOUR,
                    block_seconds: int | None = None) -> DataFrame:
    """``sender_tx_count_1h`` (rows in the trailing hour, peers included),
    ``sender_amount_sum_1h`` and the whole-sender baseline
    ``sender_avg_amount``, all from one exchange by (sender, time block)."""
    if block_seconds is None:
        block_seconds = auto_block_seconds(df, [sender], ts, frame_seconds, wide=[h * HOUR for h in (24, 12, 8, 6, 4, 3, 2)])
    money = {"_amt": F.col("amount").cast(MONEY), "_amt_n": F.when(F.col("amount").isNotNull(), F.lit(1))}
    out = sliding_sums(
        df, [sender], ts,
        [("sender_tx_count_1h", frame_seconds, None), ("_sum_1h", frame_seconds, "_amt")],
        block_seconds, totals=[("_tot_s", "_amt"), ("_tot_n", "_amt_n")], derive=money, needs=["amount"])
    return (out.withColumns({
        "sender_amount_sum_1h": F.col("_sum_1h").cast("double"),
        "sender_avg_amount": F.col("_tot_s").cast("double") / F.col("_tot_n").cast("double")})
        .drop("_sum_1h", "_tot_s", "_tot_n"))


def sender_baseline(df: DataFrame, sender: str = "sender_account_masked") -> DataFrame:
    """Per-sender average amount over all of the sender's rows (partial
    aggregate, so a hot sender is combined map-side)."""
    return df.groupBy(sender).agg(
        (F.sum(F.col("amount").cast(MONEY)).cast("double")
         / F.count("amount").cast("double")).alias("sender_avg_amount"))


def sender_trailing_baseline(df: DataFrame, sender: str = "sender_account_masked",
                             ts: str = "timestamp", block_seconds: int | None = None) -> DataFrame:
    """``sender_avg_amount_trailing``: the sender's average amount over its
    rows up to and including ``t`` (peers included), so no future row leaks
    into the baseline. Same block split as the 1h window."""
    if block_seconds is None:
        block_seconds = auto_block_seconds(df, [sender], ts, HOUR)
    df = df.withColumns({"_amt": F.col("amount").cast(MONEY),
                         "_amt_n": F.when(F.col("amount").isNotNull(), F.lit(1))})
    out = sliding_sums(df, [sender], ts, [("_cs", None, "_amt"), ("_cn", None, "_amt_n")],
                       block_seconds)
    return (out.withColumn("sender_avg_amount_trailing",
                           F.col("_cs").cast("double") / F.col("_cn").cast("double"))
            .drop("_cs", "_cn", "_amt", "_amt_n"))


def rule_features(df: DataFrame) -> DataFrame:
    df = df.withColumns({
        "_ptr": R.payment_type_risk_decimal("payment_type"),
        "is_high_risk_type": R.is_high_risk_type("payment_type"),
        "is_structuring": R.is_structuring("amount"),
        "is_round_amount": R.is_round_amount("amount"),
    })
    df = df.withColumn("payment_type_risk", F.col("_ptr"))
    df = df.withColumn("rule_score", R.rule_score())
    return df.withColumn("payment_type_risk", F.col("_ptr").cast("double")).drop("_ptr")


def with_short_ids(df: DataFrame, id_col: str = "transaction_id") -> DataFrame:
    """The id as 16 bytes where it is a lower-case digest (``_id16``), as it is elsewhere (``_id``)."""
    digest = F.col(id_col).rlike(r"\A[0-9a-f]{32}\z")
    return df.withColumns({"_id16": F.when(digest, F.unhex(id_col)), "_id": F.when(~digest, F.col(id_col))}).drop(id_col)


def with_long_ids(df: DataFrame, id_col: str = "transaction_id") -> DataFrame:
    return df.withColumn(id_col, F.coalesce(F.lower(F.hex("_id16")), F.col("_id"))).drop("_id16", "_id")


def gold_features(silver: DataFrame, sender: str = "sender_account_masked",
                  block_seconds: int | None = None, derive: bool = False) -> DataFrame:
    """Silver -> the 28 gold columns. ``derive``: silver's derived columns are
    made anew after the rows have moved, not moved with them.

    One exchange by (sender, time block) feeds the 1h window and a small
    (sender, block) table feeds the baseline; the block is chosen so the
    busiest block of the hottest sender stays bounded (see ``sliding``)."""
    rows = with_short_ids(silver.drop(*ST.DERIVED) if derive else silver)
    g = with_long_ids(sender_velocity(rows, sender=sender, block_seconds=block_seconds))
    if derive:
        g = ST.with_derived(g)
    g = rule_features(g)
    g = g.withColumn("amount_vs_sender_avg", R.amount_vs_sender_avg())
    return g.select(*S.GOLD_COLUMNS)


def long_window_features(df: DataFrame, sender: str = "sender_account_masked",
                         ts: str = "timestamp", block_seconds: int | None = None) -> DataFrame:
    """time_bucket, 7d and 30d trailing counts of ids on unix seconds."""
    if block_seconds is None:
        block_seconds = auto_block_seconds(df, [sender], ts, 7 * DAY, also_divide=(30 * DAY,))
    df = df.withColumns({"time_bucket": C.time_bucket(ts),
                         "_id_n": F.when(F.col("transaction_id").isNotNull(), F.lit(1))})
    out = sliding_sums(
        df, [sender], ts,
        [("rolling_7d_tx_count", 7 * DAY, "_id_n"), ("rolling_30d_tx_count", 30 * DAY, "_id_n")],
        block_seconds, time_unit_seconds=1)
    return out.withColumns({
        "rolling_7d_tx_count": F.coalesce(F.col("rolling_7d_tx_count").cast("bigint"), F.lit(0)),
        "rolling_30d_tx_count": F.coalesce(F.col("rolling_30d_tx_count").cast("bigint"), F.lit(0)),
    }).drop("_id_n")


def amount_zscore(df: DataFrame, group: str = "payment_type") -> DataFrame:
    """(amount - mean) / sample stddev within the group; 0 when the stddev is
    0 or undefined. Stats are a small grouped aggregate joined back (AQE
    broadcasts it at runtime when it is small)."""
    stats = df.groupBy(group).agg(F.avg("amount").alias("_mu"),
                                  F.stddev_samp("amount").alias("_sd"))
    j = df.join(stats, group, "left")
    z = F.when(F.col("_sd") > 0, (F.col("amount") - F.col("_mu")) / F.col("_sd")).otherwise(F.lit(0.0))
    return j.withColumn("amount_zscore", z).drop("_mu", "_sd")
