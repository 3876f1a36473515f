"""Exact trailing-frame counts and sums split into small time blocks.

For a frame of ``f`` time units and blocks of ``W`` units (``W`` divides
``f``), the rows of a key inside ``[t - f, t]`` are:

* rows of t's own block up to ``t`` (peers included): a running window
  inside the ``(key, block)`` partition;
* rows of the block exactly ``f`` earlier with time ``>= t - f``: those
  rows are copied once, as narrow context rows, into the partition ``f/W``
  blocks later, and counted as (all context rows) - (context rows up to
  ``t - f - 1``), two frames Spark evaluates in one linear pass;
* all rows of the blocks in between: a prefix over a small
  ``(key, block) -> count, sum`` table (at most one row per key and block),
  joined back on ``(key, block)``, which is already the partitioning of the
  rows, so only the small table moves.

A block may also be several frames long (``f`` divides ``W``). Then only the rows in
the last ``f`` of a block are copied, into the next one, and a sum is the
difference of two running sums over the block and those rows.

A task therefore holds at most two blocks of one key's rows, however hot the
key and however long the frame; ``block_seconds`` sets that size. Sums of
money run in decimal, so results are exact and independent of order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwatch.functions.columns import epoch_micros

US = 1_000_000
BLOCK = "_blk"
NO_TIME = 1 << 60


def order_value(ts_col: str, dtype, time_unit_seconds: int | None) -> Column:
    """Microseconds since epoch, or whole ``time_unit_seconds`` units."""
    us = epoch_micros(ts_col, dtype)
    if not time_unit_seconds:
        return us
    unit = F.lit(time_unit_seconds * US)
    return ((us - F.pmod(us, unit)) / unit).cast("bigint")


def auto_block_seconds(df: DataFrame, keys: Sequence[str], ts_col: str, frame_seconds: int,
                       target_rows: int = 2_000_000, candidates: Sequence[int] | None = None,
                       also_divide: Sequence[int] = (), wide: Sequence[int] = ()) -> int:
    """Largest block (a divisor of the frame) whose busiest ``(key, block)``
    holds at most ``target_rows`` rows, estimated from the busiest
    ``(key, frame)`` cell. One grouped aggregate; one number reaches the
    driver. Of the blocks in ``wide`` (multiples of the frame) the largest goes
    first whose busiest cell holds at most half of that."""
    dtype = df.schema[ts_col].dataType
    o = order_value(ts_col, dtype, None)

    def busiest_of(seconds: int) -> int:
        unit = F.lit(seconds * US)
        return (df.groupBy(*keys, ((o - F.pmod(o, unit)) / unit).cast("bigint").alias("_f"))
                .agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0)

    wide = sorted((w for w in wide if w > frame_seconds and w % frame_seconds == 0), reverse=True)
    busiest = busiest_of(wide[0]) if wide else 0
    for w in wide:
        if busiest * w / wide[0] <= target_rows / 2:
            return w
    busiest = busiest_of(frame_seconds)
    divs = (frame_seconds, *also_divide)
    cands = sorted(candidates or [d for d in (1, 5, 10, 30, 60, 300, 600, 900, 1800, 3600, 7200,
                                              21600, 43200, 86400) if all(x % d == 0 for x in divs)],
                   reverse=True)
    for c in cands:
        if busiest * c / frame_seconds <= target_rows:
            return c
    return cands[-1]


def sliding_sums(
    df: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    frames: Sequence[tuple[str, int | None, str | None]],
    block_seconds: int,
    time_unit_seconds: int | None = None,
    totals: Sequence[tuple[str, str | None]] = (),
    derive: dict[str, Column] | None = None,
    needs: Sequence[str] = (),
) -> DataFrame:
    """Add one column per ``(name, frame_seconds, value_col)``: the count of
    the key's rows in ``[t - frame, t]`` when ``value_col`` is None, else the
    sum of ``value_col`` over them (null when no value). A frame of ``None``
    is cumulative (all of the key's rows up to ``t``): the own block's
    running sum plus a prefix over all earlier blocks of the small table.
    ``totals`` adds ``(name, value_col)`` whole-key counts/sums. Rows without a
    time see one another (and, cumulatively, all rows of their key). A block
    longer than a frame needs values that add up exactly (no floating point).

    ``derive`` gives value columns as expressions of the columns ``needs``; they
    are made after the rows have moved and are not in the result."""
    derive = derive or {}
    unit_s = time_unit_seconds or 0
    scale = US if not unit_s else 1 / unit_s
    w_len = int(block_seconds * scale)
    if w_len <= 0:
        raise ValueError("block must be at least one time unit")
    specs = []
    for name, f_sec, val in frames:
        if f_sec is None:
            specs.append((name, None, None, val))
            continue
        f_len = int(f_sec * scale)
        if f_len % w_len and w_len % f_len:
            raise ValueError(f"block of {block_seconds}s must divide the {f_sec}s frame or be a multiple of it")
        specs.append((name, f_len, max(1, f_len // w_len), val))
    values = sorted({v for *_, v in specs if v} | {v for _, v in totals if v})

    dtype = df.schema[ts_col].dataType
    base = df.withColumn("_ord", order_value(ts_col, dtype, time_unit_seconds))
    # Null keys form one group and null times are last, in a block of their
    # own, as in a SQL window; the join below then needs no null-safe equality.
    base = base.withColumn(BLOCK, F.coalesce(F.expr(f"(_ord - pmod(_ord, {w_len})) div {w_len}"), F.lit(NO_TIME)))
    names, keys, restored = list(keys), [], {}
    for i, name in enumerate(names):
        base = base.withColumns({f"_k{i}": F.coalesce(F.col(name).cast("string"), F.lit("")),
                                 f"_n{i}": F.col(name).isNull()})
        keys += [f"_k{i}", f"_n{i}"]
        if df.schema[name].dataType == T.StringType():  # the text moves once
            restored[name] = F.when(~F.col(f"_n{i}"), F.col(f"_k{i}")).alias(name)

    # Own rows (wide) plus one narrow context copy per distinct hop f/W.
    hops = sorted({h for _, _, h, _ in specs if h is not None})
    moved = [v for v in values if v not in derive] + [c for c in needs if c not in values and c != ts_col]
    own = base.withColumn("_hop", F.lit(0)).drop(*restored)
    narrow = base.select(*keys, ts_col, "_ord", BLOCK, *moved)
    parts = [own]
    for h in hops:
        longest = max(f for _, f, hop, _ in specs if hop == h)
        seen = F.col("_ord").isNotNull() if longest >= w_len else F.expr(f"pmod(_ord, {w_len}) >= {w_len - longest}")
        parts.append(narrow.where(seen).withColumn(BLOCK, F.col(BLOCK) + h).withColumn("_hop", F.lit(h)))
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p, allowMissingColumns=True)
    if derive:  # the order value follows from the time as well
        again = derive | {"_ord": order_value(ts_col, dtype, time_unit_seconds)}
        both = both.drop("_ord").repartition(*keys, BLOCK).withColumns(again)
        base = base.withColumns(derive)
    inexact = [val for _, f, _, val in specs if val and f and f < w_len and isinstance(base.schema[val].dataType, (T.DoubleType, T.FloatType))]
    if inexact:
        raise ValueError(f"a block longer than the frame needs exact values, {inexact} are not")

    w = Window.partitionBy(*keys, BLOCK).orderBy("_ord")
    is_own = F.col("_hop") == 0

    def weight(val, mask):
        return F.when(mask, F.lit(1) if val is None else F.col(val))

    cols = {}
    whole_part = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    for name, f_len, h, val in specs:
        if f_len is not None and f_len < w_len:
            # all rows up to t less those up to t - f - 1 (a row without a time sees all of its block)
            near = F.col("_hop") <= 1

            def in_frame(total, f_len=f_len):
                before = total.over(w.rangeBetween(Window.unboundedPreceding, -(f_len + 1)))
                return (total.over(w.rangeBetween(Window.unboundedPreceding, 0))
                        - F.when(F.col("_ord").isNull(), F.lit(0)).otherwise(F.coalesce(before, F.lit(0))))

            found = in_frame(F.sum(weight(val, near)))
            cols[f"_fine_{name}"] = found if val is None else F.when(in_frame(F.count(weight(val, near))) > 0, found)
            cols[f"_start_{name}"] = F.lit(None).cast("long" if val is None else base.schema[val].dataType)
            continue
        fine = F.sum(weight(val, is_own)).over(w.rangeBetween(Window.unboundedPreceding, 0))
        cols[f"_fine_{name}"] = fine
        if h is None:
            cols[f"_start_{name}"] = F.lit(None).cast("long" if val is None else
                                                       base.schema[val].dataType)
            continue
        # context rows with time >= t - f = all context rows minus those with
        # time <= t - f - 1 (two linear frames; an "unbounded following"
        # frame would be recomputed for every row)
        ctx = weight(val, F.col("_hop") == h)
        ctx_all = F.sum(ctx).over(whole_part)
        ctx_before = F.sum(ctx).over(w.rangeBetween(Window.unboundedPreceding, -(f_len + 1)))
        start = F.when(ctx_all.isNotNull(), ctx_all - F.coalesce(ctx_before, F.lit(0)))
        cols[f"_start_{name}"] = start
    windowed = both.withColumns(cols).where(is_own)

    # Small table: per (key, block) counts/sums, prefix over whole blocks.
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.sum(v).alias(f"_s_{v}") for v in values]
    coarse = base.groupBy(*keys, BLOCK).agg(*aggs)
    cw = Window.partitionBy(*keys).orderBy(BLOCK)
    mids = {}
    for name, _, h, val in specs:
        src = "_n" if val is None else f"_s_{val}"
        if h is None:
            mids[f"_mid_{name}"] = F.sum(src).over(cw.rangeBetween(Window.unboundedPreceding, -1))
        elif h > 1:
            mids[f"_mid_{name}"] = F.sum(src).over(cw.rangeBetween(-(h - 1), -1))
        else:
            mids[f"_mid_{name}"] = F.lit(None).cast(coarse.schema[src].dataType)
    whole = Window.partitionBy(*keys)
    for tname, val in totals:
        src = "_n" if val is None else f"_s_{val}"
        mids[f"_tot_{tname}"] = F.sum(src).over(whole)
    coarse = coarse.select(*keys, BLOCK, *[c.alias(k) for k, c in mids.items()])

    out = windowed.join(coarse, [*keys, BLOCK], "left")
    result = {}
    for name, _, _, val in specs:
        parts_ = [F.col(f"_fine_{name}"), F.col(f"_start_{name}"), F.col(f"_mid_{name}")]
        if val is None:
            result[name] = sum((F.coalesce(p, F.lit(0)) for p in parts_[1:]),
                               F.coalesce(parts_[0], F.lit(0))).cast("bigint")
        else:
            # null only when no row of the frame has a value (SQL SUM semantics)
            present = F.coalesce(*parts_).isNotNull()
            total = parts_[0]
            for p in parts_[1:]:
                total = F.coalesce(total, F.lit(0)) + F.coalesce(p, F.lit(0))
            result[name] = F.when(present, total)
    for tname, _ in totals:
        result[tname] = F.col(f"_tot_{tname}")
    rest = {c: F.col(c) for c in df.columns} | restored | {c: e.alias(c) for c, e in result.items()}
    return out.select(*rest.values())
