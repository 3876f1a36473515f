"""Stream queries whose keyed state is split by time."""

from __future__ import annotations

from txwatch.oracle import RUN_TS
from txwatch.plans.catalog import register
from txwatch.plans.queries_more import _events_sql
from txwatch.session import materialize
from txwatch.sources import testdata as TD
from txwatch.streaming import alerts as SA
from txwatch.streaming import blocks as SB


@register("stream_trailing_blocks", _events_sql("""
SELECT * FROM (
  SELECT transaction_id, sender_account_masked, timestamp,
    COUNT(*) OVER w AS sender_tx_count_1h,
    CAST(SUM(CAST(amount AS DECIMAL(24,6))) OVER w AS DOUBLE) AS sender_amount_sum_1h
  FROM evp
  WINDOW w AS (PARTITION BY sender_account_masked ORDER BY timestamp
               RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW))
WHERE timestamp <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 60 MINUTE"""))
def stream_trailing_blocks(spark, sf):
    """Per-event trailing-hour velocity on a stream, state keyed by sender and block
    of time, for all events that the final watermark has passed."""
    return SB.stream_trailing_blocks(spark, sf)


@register("stream_alerts", _events_sql(f"""
avgs AS (SELECT sender_account_masked, CAST(SUM(CAST(amount AS DECIMAL(24,6))) AS DOUBLE) / CAST(COUNT(amount) AS DOUBLE) AS average
         FROM evp GROUP BY 1)
SELECT md5(transaction_id || '{RUN_TS}') AS alert_id, transaction_id, sender_account_masked, timestamp, amount,
       amount / greatest(average, 0.01) AS amount_vs_sender_avg
FROM evp JOIN avgs USING (sender_account_masked) WHERE amount >= 0 AND amount / greatest(average, 0.01) >= {SA.RATIO}"""))
def stream_alerts(spark, sf):
    """Events far above their sender's average, as a stream joined to a table of averages."""
    averages = materialize(SA.sender_averages(TD.events_payments(spark, sf)), "sender-averages")
    return SA.stream_alerts(spark, sf, averages, RUN_TS)
