"""Trailing sums on a stream, with a key's state split into time blocks.

State keyed by the sender alone puts a busy sender's whole frame into one task.
Here the key is ``(part, block of time)``, where a part is a hash of the sender:
an event goes to its own block, to the block one frame later (whose events still
see a part of this one), and, as one number to add, to each block in between. A
block's state is the events of two blocks and a sum a sender, and the blocks of
one sender lie in different tasks.

A call to the state store costs far more than an event, so the keys are few (the
blocks times ``PARTS``, however many senders there are), a batch appends one
chunk (an Arrow table) to a key's state, and a key's senders are answered side by
side.

Events are answered once the watermark has passed them, so every answer counts
all events in ``[t - frame, t]`` whatever order they came in, and equals the
batch window (a batch takes its rows in before it answers, and Spark leaves out rows
that an earlier answer has passed). A timer wakes a block at its next unanswered event; another one
drops its state at its end. Events later than the watermark allows are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from txwatch.streaming.streams import VELOCITY_OUT, events_to_payments, read_event_stream, run_available

OWN, BETWEEN, BEFORE = 0, 1, 2
US = 1_000_000
#: Senders are dealt into so many parts; a key holds the events of two blocks of one part.
PARTS = 16
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def routed(events: DataFrame, frame_us: int, block_us: int, parts: int = PARTS) -> DataFrame:
    """Each event once for every block that needs it, as ``part, block, kind`` and its columns."""
    if block_us < 1000 or frame_us % block_us:
        raise ValueError("whole blocks of a millisecond or more must make up the frame")
    hops = frame_us // block_us
    block = F.expr(f"(t - pmod(t, {block_us})) div {block_us}")
    places = F.array(F.struct(block.alias("block"), F.lit(OWN).alias("kind")),
                     *[F.struct((block + k).alias("block"), F.lit(BETWEEN).alias("kind")) for k in range(1, hops)],
                     F.struct((block + hops).alias("block"), F.lit(BEFORE).alias("kind")))
    return (events.withColumn("place", F.explode(places))
            .select(F.pmod(F.xxhash64("sender"), F.lit(parts)).cast("int").alias("part"), "place.block", "place.kind", "sender",
                    F.when(F.col("place.kind") == OWN, F.col("transaction_id")).alias("transaction_id"), "t", "micros", "event_time"))


CHUNK = "chunk binary"
OWN_ROWS = pa.schema([("sender", pa.string()), ("transaction_id", pa.string()), ("t", pa.int64()), ("micros", pa.int64())])
BEFORE_ROWS = pa.schema([("sender", pa.string()), ("t", pa.int64()), ("micros", pa.int64())])
BETWEEN_ROWS = pa.schema([("sender", pa.string()), ("n", pa.int64()), ("micros", pa.int64())])


def pack(rows: pd.DataFrame, schema: pa.Schema) -> tuple[bytes]:
    """Rows as one value of a list state."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        out.write_table(pa.Table.from_pandas(rows, schema, preserve_index=False))
    return (sink.getvalue().to_pybytes(),)


def unpack(state, schema: pa.Schema) -> pd.DataFrame:
    """All rows of a list state."""
    chunks = [pa.ipc.open_stream(x[0]).read_all() for x in state.get()] if state.exists() else []
    return pa.concat_tables([schema.empty_table(), *chunks]).to_pandas()


class TrailingBlock(StatefulProcessor):
    """One block of the senders of one part."""

    def __init__(self, frame_us: int, block_us: int):
        self.frame, self.block = frame_us, block_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.own = handle.getListState("own", CHUNK)
        self.before = handle.getListState("before", CHUNK)
        self.between = handle.getListState("between", CHUNK)
        self.answered = handle.getValueState("answered", "t long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        new["micros"] = new["micros"].fillna(0).astype("int64")
        kind = new["kind"]
        if (kind == BETWEEN).any():
            sums = new[kind == BETWEEN].groupby("sender", dropna=False).agg(n=("t", "size"), micros=("micros", "sum")).reset_index()
            self.between.appendValue(pack(sums, BETWEEN_ROWS))
        if (kind == BEFORE).any():
            self.before.appendValue(pack(new.loc[kind == BEFORE, BEFORE_ROWS.names], BEFORE_ROWS))
        if (kind == OWN).any():
            mine = new.loc[kind == OWN, OWN_ROWS.names]
            self.own.appendValue(pack(mine, OWN_ROWS))
            self.handle.registerTimer(int(-(-int(mine["t"].min()) // 1000)))
        self.handle.registerTimer(self._end(key))
        return iter(())

    def _end(self, key) -> int:
        return int(-(-(int(key[1]) + 1) * self.block // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        done = self.answered.get()[0] if self.answered.exists() else None
        if done is None or done < now:
            own = unpack(self.own, OWN_ROWS)
            t = own["t"].to_numpy()
            wanted = (t <= now) if done is None else (t <= now) & (t > done)
            if wanted.any():
                yield self._answers(own, wanted)
            if len(own):
                self.answered.update((now,))
            later = t[t > now]
            if len(later):
                self.handle.registerTimer(int(-(-int(later.min()) // 1000)))
        if now >= self._end(key) * 1000:
            for state in (self.own, self.before, self.between, self.answered):
                state.clear()

    def _answers(self, own: pd.DataFrame, wanted: np.ndarray) -> pd.DataFrame:
        """All senders side by side: a sender's times lie in a span of their own."""
        old, mid = unpack(self.before, BEFORE_ROWS), unpack(self.between, BETWEEN_ROWS)
        names = pd.concat([own["sender"], old["sender"], mid["sender"]], ignore_index=True)
        codes, kinds = pd.factorize(names, use_na_sentinel=False)
        own_s, old_s, mid_s = np.split(codes.astype(np.int64), [len(own), len(own) + len(old)])
        every = np.concatenate([own["t"].to_numpy(), old["t"].to_numpy()])
        low = every.min() - self.frame
        span = every.max() - low + 1

        def running(sender, rows):
            at = sender * span + (rows["t"].to_numpy() - low)
            order = np.argsort(at, kind="stable")
            return at[order], np.concatenate([[0], np.cumsum(rows["micros"].to_numpy()[order])])

        own_at, own_sum = running(own_s, own)
        old_at, old_sum = running(old_s, old)
        n, total = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
        np.add.at(n, mid_s, mid["n"].to_numpy())
        np.add.at(total, mid_s, mid["micros"].to_numpy())
        mine, sender = own[wanted], own_s[wanted]
        at = sender * span + (mine["t"].to_numpy() - low)
        first, upto = np.searchsorted(own_at, sender * span, side="left"), np.searchsorted(own_at, at, side="right")
        since, end = np.searchsorted(old_at, at - self.frame, side="left"), np.searchsorted(old_at, (sender + 1) * span, side="left")
        return pd.DataFrame({
            "transaction_id": mine["transaction_id"].to_numpy(),
            "sender_account_masked": mine["sender"].to_numpy(),
            "timestamp": pd.to_datetime(mine["t"].to_numpy(), unit="us"),
            "sender_tx_count_1h": upto - first + end - since + n[sender],
            "sender_amount_sum_1h": (own_sum[upto] - own_sum[first] + old_sum[end] - old_sum[since] + total[sender]) / 1e6})


def stream_trailing_blocks(spark: SparkSession, sf_dir: str, delay_seconds: int = 3600, frame_seconds: int = 3600,
                           block_seconds: int = 3600, max_files: int | None = None, sender: str = "sender_account_masked", parts: int = PARTS) -> DataFrame:
    """Per event the count and sum of its sender's last frame, for all events that
    the final watermark (latest event less the delay) has passed.

    Events without a time have no frame and are left out. ``block_seconds``
    divides the frame; smaller blocks spread a busy sender over more tasks, for
    one narrow copy of an event a block; ``parts`` is the number of keys a block."""
    rows = events_to_payments(read_event_stream(spark, sf_dir, max_files)).where(F.col("timestamp").isNotNull())
    events = rows.select(
        "transaction_id", F.col(sender).alias("sender"), F.unix_micros(F.col("timestamp").cast(T.TimestampType())).alias("t"),
        (F.col("amount").cast("decimal(24,6)") * US).cast("bigint").alias("micros"),
        F.col("timestamp").cast(T.TimestampType()).alias("event_time")).withWatermark("event_time", f"{delay_seconds} seconds")
    frame_us, block_us = frame_seconds * US, block_seconds * US
    answered = (routed(events, frame_us, block_us, parts).groupBy("part", "block")
                .transformWithStateInPandas(TrailingBlock(frame_us, block_us), VELOCITY_OUT, "append", "EventTime"))
    previous = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)  # the store that holds lists, values and timers
    try:
        return run_available(answered, spark, "trailing-blocks")
    finally:
        spark.conf.unset(STORE) if previous is None else spark.conf.set(STORE, previous)
