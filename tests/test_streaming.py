"""Streams over the events files finish with availableNow and agree with batch."""
from pyspark.sql import functions as F

from tests.conftest import SF001
from txwatch.sources import testdata as TD
from txwatch.streaming import streams as SS


def test_stream_dedup_keeps_each_id_once(spark):
    out = SS.stream_dedup(spark, SF001)
    n = TD.read_table(spark, SF001, "events").count()
    assert out.count() == n == out.select("transaction_id").distinct().count()


def test_stream_clean_splits(spark):
    out = SS.stream_clean(spark, SF001)
    assert out.count() == TD.read_table(spark, SF001, "events").where(F.col("value") >= 0).count()


def test_stream_velocity_matches_batch(spark):
    """Append mode emits a window once the watermark (max event time - 60
    min) passes its end, so every streamed window equals the batch window and
    only windows ending after the watermark are still open."""
    stream = SS.stream_velocity(spark, SF001)
    payments = TD.events_payments(spark, SF001)
    batch = SS.sliding_velocity(payments)
    key = ["window_start", "sender_account_masked", "tx_count", "amount_sum"]
    s = {(str(r[0])[:19],) + tuple(r[1:]) for r in
         stream.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"), *key[1:]).collect()}
    b = {(str(r[0])[:19],) + tuple(r[1:]) for r in
         batch.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"), *key[1:]).collect()}
    assert s <= b
    wm = payments.agg(F.max("timestamp")).first()[0]
    import datetime as dt
    open_after = wm - dt.timedelta(minutes=60)
    for w in b - s:
        end = dt.datetime.strptime(w[0], "%Y-%m-%d %H:%M:%S") + dt.timedelta(hours=1)
        assert end > open_after


def test_trailing_velocity_state_across_batches(spark, tmp_path):
    """Two files (split by time), one per trigger: the second micro-batch
    needs the first one's state; the result equals the batch window."""
    import pyarrow.parquet as pq

    from txwatch.operators.features import sender_velocity
    tab = pq.read_table(f"{SF001}/events.parquet").sort_by("ts")
    half = tab.num_rows // 2
    pq.write_table(tab.slice(0, half), tmp_path / "events_1.parquet")
    pq.write_table(tab.slice(half), tmp_path / "events_2.parquet")
    got = SS.stream_trailing_velocity(spark, str(tmp_path), max_files=1)
    batch = sender_velocity(TD.events_payments(spark, SF001), block_seconds=3600)
    key = ["transaction_id", "sender_tx_count_1h", "sender_amount_sum_1h"]
    assert sorted(tuple(r) for r in got.select(*key).collect()) == \
        sorted(tuple(r) for r in batch.select(*key).collect())
