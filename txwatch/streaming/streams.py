"""Structured Streaming variants of the batch steps.

A file stream over Parquet drops in the same column functions as batch;
``foreachBatch`` writes both sides of the dead-letter split; dedup keeps the
first copy of an id within a watermark; sender velocity is a sliding
event-time window. ``run_available`` drives a stream with
``trigger(availableNow=True)`` into a Parquet sink under the shared
checkpoint folder and returns the sink as a batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwatch.functions import columns as C
from txwatch.session import scratch_path

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def read_event_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{sf_dir.rstrip('/')}/events*.parquet")


def events_to_payments(events: DataFrame) -> DataFrame:
    """Events as payment rows (works on batch and streaming frames)."""
    return events.select(
        F.md5(F.concat(F.lit("evt_"), F.col("event_id").cast("string"))).alias("transaction_id"),
        F.col("ts").alias("timestamp"),
        C.mask_account(F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("sender_account_masked"),
        F.col("event_type").alias("payment_type"),
        F.col("value").alias("amount"),
        C.tx_hour("ts").alias("tx_hour"),
        C.tx_day_of_week("ts").alias("tx_day_of_week"),
        C.amount_log("value").alias("amount_log"),
        (F.col("value").isNull() | (F.col("value") < 0) | F.col("user_id").isNull()).alias("_bad"),
    )


def run_available(stream: DataFrame, spark: SparkSession, name: str,
                  output_mode: str = "append") -> DataFrame:
    """Run a streaming DataFrame to completion over the available input into
    a Parquet sink; return the sink as a batch DataFrame."""
    out = scratch_path(spark, f"stream-{name}")
    q = (stream.writeStream.format("parquet").outputMode(output_mode)
         .option("path", f"{out}/data").option("checkpointLocation", f"{out}/_chk")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{out}/data")


def stream_clean(spark: SparkSession, sf_dir: str, dead: bool = False) -> DataFrame:
    """Standardise a stream; each micro-batch writes clean and dead rows in one
    pass, into a folder of its own that a replay overwrites. Returns the clean
    rows, or the dead ones."""
    out = scratch_path(spark, "stream-clean")
    rows = events_to_payments(read_event_stream(spark, sf_dir))

    def write_both(batch: DataFrame, epoch_id: int) -> None:
        (batch.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_bad")
         .parquet(f"{out}/rows/batch_id={epoch_id}"))

    q = (rows.writeStream.foreachBatch(write_both)
         .option("checkpointLocation", f"{out}/_chk").trigger(availableNow=True).start())
    q.awaitTermination()
    schema = T.StructType([*rows.drop("_bad").schema.fields, T.StructField("batch_id", T.StringType()),
                           T.StructField("_bad", T.StringType())])
    both = spark.read.schema(schema).parquet(f"{out}/rows")
    return both.where(F.col("_bad") == str(dead).lower()).drop("_bad", "batch_id")


def stream_dedup(spark: SparkSession, sf_dir: str, delay: str = "60 minutes") -> DataFrame:
    """First copy of each id within the watermark (event time must be a
    ``timestamp``, so the NTZ column is cast first). Every tenth event comes
    twice, so that there is something to drop."""
    events = read_event_stream(spark, sf_dir)
    again = F.when(F.col("event_id") % 10 == 0, F.lit(1)).otherwise(F.lit(0))
    events = events.withColumn("_copy", F.explode(F.sequence(F.lit(0), again))).drop("_copy")
    rows = (events_to_payments(events).drop("_bad")
            .withColumn("event_time", F.col("timestamp").cast(T.TimestampType())))
    deduped = (rows.withWatermark("event_time", delay)
               .dropDuplicatesWithinWatermark(["transaction_id"]))
    return run_available(deduped, spark, "dedup")


def sliding_velocity(df: DataFrame, ts: str = "timestamp", sender: str = "sender_account_masked",
                     length: str = "1 hour", slide: str = "10 minutes") -> DataFrame:
    """Per sender and sliding window: count and amount (batch or stream)."""
    w = F.window(ts, length, slide)
    return (df.groupBy(w.alias("w"), sender)
            .agg(F.count(F.lit(1)).alias("tx_count"),
                 F.sum(F.col("amount").cast("decimal(24,6)")).cast("double").alias("amount_sum"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    sender, "tx_count", "amount_sum"))


def stream_velocity(spark: SparkSession, sf_dir: str, delay: str = "60 minutes",
                    length: str = "1 hour", slide: str = "10 minutes") -> DataFrame:
    """Sender windows on a watermarked stream; append mode emits a window
    once the watermark (max event time - ``delay``) passes its end. Window
    bounds come back as timestamp_ntz, like the batch form."""
    rows = (events_to_payments(read_event_stream(spark, sf_dir)).drop("_bad")
            .withColumn("event_time", F.col("timestamp").cast(T.TimestampType()))
            .withWatermark("event_time", delay))
    out = run_available(sliding_velocity(rows, ts="event_time", length=length, slide=slide),
                        spark, "velocity")
    return out.withColumns({"window_start": F.col("window_start").cast(T.TimestampNTZType()),
                            "window_end": F.col("window_end").cast(T.TimestampNTZType())})


def stream_scores(spark: SparkSession, stream: DataFrame, model) -> DataFrame:
    """Score a stream with a fitted pipeline model (same transform as batch)."""
    from txwatch.operators.ml import score
    return score(model, stream)


VELOCITY_OUT = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("sender_account_masked", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("sender_tx_count_1h", T.LongType()),
    T.StructField("sender_amount_sum_1h", T.DoubleType()),
])
VELOCITY_STATE = T.StructType([
    T.StructField("ts_us", T.ArrayType(T.LongType())),
    T.StructField("micros", T.ArrayType(T.LongType())),
])


def _trailing_hour(frame_us: int, delay_us: int):
    """Per-sender state function: state keeps the sender's events of the last
    ``frame_us + delay_us`` (by event time), which is what an event that is
    ``delay_us`` late can still need; each new event gets the count and sum of
    the state plus batch events in ``[t - frame, t]``. Money is summed in whole
    millionths, as the batch form does."""
    import numpy as np
    import pandas as pd

    def fn(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        old_ts, old_c = (np.array(state.get[0], dtype=np.int64), np.array(state.get[1], dtype=np.int64)) \
            if state.exists else (np.empty(0, np.int64), np.empty(0, np.int64))
        new = pd.concat(list(pdfs), ignore_index=True)
        epoch = pd.Timestamp("1970-01-01")
        new_ts = ((new["timestamp"] - epoch) // pd.Timedelta(microseconds=1)).to_numpy(np.int64)
        new_c = new["micros"].fillna(0).to_numpy().astype(np.int64)
        ts = np.concatenate([old_ts, new_ts])
        micros = np.concatenate([old_c, new_c])
        order = np.argsort(ts, kind="stable")
        ts, micros = ts[order], micros[order]
        csum = np.concatenate([[0], np.cumsum(micros)])
        lo = np.searchsorted(ts, new_ts - frame_us, side="left")
        hi = np.searchsorted(ts, new_ts, side="right")
        yield pd.DataFrame({
            "transaction_id": new["transaction_id"],
            "sender_account_masked": key[0],
            "timestamp": new["timestamp"],
            "sender_tx_count_1h": (hi - lo).astype(np.int64),
            "sender_amount_sum_1h": (csum[hi] - csum[lo]) / 1e6,
        })
        keep = ts >= ts.max() - frame_us - delay_us
        state.update((ts[keep].tolist(), micros[keep].tolist()))
        state.setTimeoutTimestamp(int(ts.max() // 1000 + frame_us // 1000))
    return fn


def stream_trailing_velocity(spark: SparkSession, sf_dir: str, delay_seconds: int = 3600,
                             frame_seconds: int = 3600, max_files: int | None = None) -> DataFrame:
    """Per-event trailing-hour count and sum per sender on a stream (the
    stream form of the batch RANGE window). State per sender is bounded by one
    frame and one delay of its events and is dropped by an event-time timeout once the watermark passes."""
    from pyspark.sql.streaming.state import GroupStateTimeout
    rows = (events_to_payments(read_event_stream(spark, sf_dir, max_files)).drop("_bad")
            .select("transaction_id", "sender_account_masked", "timestamp",
                    (F.col("amount").cast("decimal(24,6)") * 1_000_000).cast("bigint").alias("micros"),
                    F.col("timestamp").cast(T.TimestampType()).alias("event_time"))
            .withWatermark("event_time", f"{delay_seconds} seconds"))
    out = rows.groupBy("sender_account_masked").applyInPandasWithState(
        _trailing_hour(frame_seconds * 1_000_000, delay_seconds * 1_000_000), VELOCITY_OUT, VELOCITY_STATE, "append",
        GroupStateTimeout.EventTimeTimeout)
    return run_available(out, spark, "trailing-velocity")
