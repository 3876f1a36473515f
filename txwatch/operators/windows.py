"""Exact trailing time-frame aggregates per key, split by time bucket.

``RANGE BETWEEN <f> PRECEDING AND CURRENT ROW`` partitioned by a key puts
all rows of a key into one task; one hot key (a shared account) then holds
a large share of all rows. Here the partition is ``(key, bucket)`` with
buckets of ``bucket_seconds``; rows that fall in the last ``f`` of a bucket
are also sent, as context rows, to the following bucket(s), so every frame
sees exactly the rows it would see in the unsplit window (peers included).
Context rows cost one extra narrow copy of the rows near a bucket edge and
are dropped after the window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwatch.functions.columns import epoch_micros

US = 1_000_000
BUCKET_COL = "_tb"


def bucket_index(ts_col: str, dtype, bucket_seconds: int) -> Column:
    """Index of the ``bucket_seconds``-wide time bucket holding ``ts_col``
    (same cut as ``trailing_aggregates`` uses), named ``BUCKET_COL``."""
    us = epoch_micros(ts_col, dtype)
    b = F.lit(bucket_seconds * US)
    return ((us - F.pmod(us, b)) / b).cast("bigint").alias(BUCKET_COL)


def trailing_aggregates(
    df: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    frames: Sequence[tuple[str, int, Callable[[], Column]]],
    value_cols: Sequence[str] = (),
    bucket_seconds: int | None = None,
    time_unit_seconds: int | None = None,
    keep_bucket: bool = False,
) -> DataFrame:
    """Add one column per ``(name, frame_seconds, agg_factory)``.

    ``value_cols`` are the columns the aggregates read (context rows carry
    only keys, time and these). ``time_unit_seconds`` truncates the order
    value to whole units first (``1`` = unix seconds, as a seconds-based
    range frame does); ``None`` keeps microseconds.
    """
    max_frame = max(f for _, f, _ in frames)
    bucket = bucket_seconds or max_frame
    hops = max(1, math.ceil(max_frame / bucket))
    dtype = df.schema[ts_col].dataType
    unit = (time_unit_seconds or 0) * US
    base = df.withColumn("_ord", epoch_micros(ts_col, dtype))
    if unit:
        base = base.withColumn("_ord", F.expr(f"(_ord - pmod(_ord, {unit})) div {unit}"))
        scale = 1 / time_unit_seconds
    else:
        scale = US
    b_len = int(bucket * scale)
    f_len = int(max_frame * scale)
    base = base.withColumn(BUCKET_COL, F.expr(f"(_ord - pmod(_ord, {b_len})) div {b_len}"))
    own = base.withColumn("_own", F.lit(True))
    ctx = (base.select(*keys, "_ord", BUCKET_COL, *value_cols)
           .withColumn("_hop", F.explode(F.sequence(F.lit(1), F.lit(hops))))
           .where(F.col("_ord") >= (F.col(BUCKET_COL) + F.col("_hop")) * b_len - f_len)
           .withColumn(BUCKET_COL, F.col(BUCKET_COL) + F.col("_hop"))
           .drop("_hop")
           .withColumn("_own", F.lit(False)))
    both = own.unionByName(ctx, allowMissingColumns=True)
    w = Window.partitionBy(*keys, BUCKET_COL).orderBy("_ord")
    cols = {name: agg().over(w.rangeBetween(-int(f * scale), 0)) for name, f, agg in frames}
    out = both.withColumns(cols).where(F.col("_own")).drop("_own", "_ord")
    return out if keep_bucket else out.drop(BUCKET_COL)
