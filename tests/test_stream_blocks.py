"""Trailing sums by blocks equal the batch window over several batches, in any order, for a busy sender."""
import datetime as dt
import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from txwatch.streaming import blocks as B


def plain(rows, frame):
    """``(id, count, sum)`` of each event from all events."""
    out = {}
    for i, user, t, value in rows:
        mine = [v for _, u, s, v in rows if u == user and t - frame <= s <= t]
        out[i] = (len(mine), round(sum(v or 0 for v in mine), 6))
    return out


def files(folder, parts):
    for k, rows in enumerate(parts, 1):
        i, user, t, value = (list(x) for x in zip(*rows))
        pq.write_table(pa.table({"event_id": pa.array(i, pa.int64()), "ts": pa.array(t, pa.timestamp("us")), "user_id": pa.array(user, pa.int64()),
                                 "event_type": pa.array(["ACH"] * len(i)), "value": pa.array(value, pa.float64()), "props": pa.array([None] * len(i), pa.string())}),
                       folder / f"events_{k}.parquet")
        os.utime(folder / f"events_{k}.parquet", (1_700_000_000 + 60 * k,) * 2)  # a file source goes by age


def answers(spark, out):
    import hashlib
    by_id = {hashlib.md5(f"evt_{i}".encode()).hexdigest(): i for i in range(2000)}
    return {by_id[r.transaction_id]: (r.sender_tx_count_1h, round(r.sender_amount_sum_1h, 6)) for r in out.collect()}


START = dt.datetime(2024, 1, 1, 8)


@pytest.fixture
def busy():
    """40 % of the events are one sender's; times are out of order within the delay, some are equal."""
    import random
    rng = random.Random(11)
    rows = []
    for i in range(240):
        t = START + dt.timedelta(seconds=i * 60 + rng.randint(-600, 600), microseconds=rng.choice([0, 1, 500_000, 999_999]))
        rows.append((i, 7 if i % 5 < 2 else rng.choice([None, 1, 2, 3]), t.replace(second=0) if i % 7 == 0 else t, None if i % 31 == 0 else rng.randint(1, 10**6) / 100))
    return rows


@pytest.mark.parametrize("block", [900, 3600])
def test_equals_batch_over_several_batches(spark, tmp_path, busy, block):
    files(tmp_path, [busy[:70], busy[70:150], busy[150:190], busy[190:]])
    got = answers(spark, B.stream_trailing_blocks(spark, str(tmp_path), delay_seconds=1800, block_seconds=block, max_files=1))
    want = plain(busy, dt.timedelta(hours=1))
    passed = max(t for _, _, t, _ in busy)
    passed = passed.replace(microsecond=passed.microsecond // 1000 * 1000) - dt.timedelta(seconds=1800)
    assert got == {i: want[i] for i, _, t, _ in busy if t <= passed} and len(got) > 180


def test_a_busy_sender_is_many_keys(spark, busy):
    rows = [(str(i), str(u), int((t - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1)), 1, t) for i, u, t, _ in busy if u == 7]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["transaction_id", "sender", "t", "micros", "event_time"]))
    routed = B.routed(df, 3600 * B.US, 900 * B.US)
    own = routed.where(F.col("kind") == B.OWN).groupBy("block").count().collect()
    assert len(own) >= 4 and max(r["count"] for r in own) < len(rows) / 4
    assert routed.count() == 5 * len(rows)
    with pytest.raises(ValueError):
        B.routed(df, 3600 * B.US, 1000 * B.US)


def test_late_events_are_left_out(spark, tmp_path):
    first = [(i, 1, START + dt.timedelta(minutes=10 * i), 1.0) for i in range(30)]
    more = [(101, 1, START + dt.timedelta(minutes=299), 2.0), (102, 2, START + dt.timedelta(hours=9), 1.0)]
    late = [(100, 1, START, 50.0), (103, 1, START + dt.timedelta(hours=8, minutes=30), 4.0)]
    files(tmp_path, [first, more, late])
    got = answers(spark, B.stream_trailing_blocks(spark, str(tmp_path), max_files=1))
    assert 100 not in got and got[0] == (1, 1.0) and got[6] == (7, 7.0) and got[29] == (7, 7.0)
    assert got[101] == (7, 8.0) and 102 not in got and 103 not in got  # 101 sees 24 to 29, the last two are not passed yet
    assert len(got) == 31


def test_keys_are_few_however_many_senders(spark, tmp_path):
    """A key is a block of a part: state calls do not grow with the senders, and each sender has its own answers."""
    rows = [(i, None if i % 50 == 0 else i % 300, START + dt.timedelta(seconds=20 * i), float(i)) for i in range(900)]
    df = spark.createDataFrame(pd.DataFrame([(str(i), None if u is None else str(u), int((t - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1)), 1, t)
                                             for i, u, t, _ in rows], columns=["transaction_id", "sender", "t", "micros", "event_time"]))
    hours = len({t.replace(minute=0, second=0) for _, _, t, _ in rows})
    assert B.routed(df, 3600 * B.US, 3600 * B.US).select("part", "block").distinct().count() <= B.PARTS * (hours + 1)
    files(tmp_path, [rows])
    got = answers(spark, B.stream_trailing_blocks(spark, str(tmp_path), delay_seconds=0, block_seconds=1800, parts=2))
    want = plain(rows, dt.timedelta(hours=1))
    assert got == want
