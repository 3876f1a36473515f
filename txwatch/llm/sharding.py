"""Shards along a Hilbert curve over several metadata columns.

Each metadata value gets a level of an equal-depth scale: the share of rows with
a smaller value. The levels are a cell of a cube, and cells are numbered along a
Hilbert curve, so rows that follow each other differ little in every column.
Rows are sorted by the curve and cut into runs, the shards: each covers a small
box of the cube, and a filter on any of the columns leaves out most files
(``ranges`` holds the boxes, ``prune`` reads them).

Nothing meets in one task: running sums and ranks come from range partitions,
of which the driver gets one number each. Ties are ordered by id, size,
checksum and row, so a value, a cell or an id that a third of all rows share is
spread over as many tasks as it takes.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from txwatch.session import materialize

SHARDS, BITS, DIMS = 16, 10, ("source", "lang", "n_chars")
LAW = "rows"
PLACE = 33  # a partition's rows are numbered from its own number shifted by so many bits


def hilbert(levels: list[np.ndarray], bits: int) -> np.ndarray:
    """The place of each cell on the curve through a cube of ``2**bits`` a side
    (turning axes into a transposed index by undoing reflections, then Gray code)."""
    x = [a.astype(np.int64).copy() for a in levels]
    for q in range(bits - 1, 0, -1):
        low = (1 << q) - 1
        for i in range(len(x)):
            up = (x[i] >> q & 1) == 1
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for q in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> q & 1, (1 << q) - 1, 0)
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for a in x:
            place = place << 1 | ((a ^ turn) >> bit & 1)
    return place


def _key(docs: DataFrame, name: str, dim: int) -> Column:
    """A metadata value as ``(dim, num, txt)``, which sort as the values do."""
    kind, value = docs.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, StringType):
        num, txt = F.lit(None).cast("double"), value
    else:
        if isinstance(kind, DateType):
            value = F.unix_date(value)
        elif isinstance(kind, (TimestampType, TimestampNTZType)):
            value = F.unix_micros(value.cast("timestamp"))
        num, txt = value.cast("double"), F.lit(None).cast("string")
    return F.struct(F.lit(dim).alias("dim"), num.alias("num"), txt.alias("txt"))


def ranked(frame: DataFrame, *order: str) -> DataFrame:
    """``frame`` in range partitions, each sorted and numbered in ``at``."""
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_first() for c in order]
    return materialize(frame.repartitionByRange(parts, *by).sortWithinPartitions(*by)
                       .withColumn("at", F.monotonically_increasing_id()), "ranked")


def bases(frame: DataFrame, weight: Column) -> tuple[DataFrame, int]:
    """``part, base``: what the partitions before hold (one row a partition), and the whole."""
    found = sorted((r.part, r.n) for r in frame.groupBy(F.shiftright("at", PLACE).cast("int").alias("part"))
                   .agg(F.sum(weight).alias("n")).collect())
    ends = list(accumulate(n for _, n in found))
    rows = [(part, end - n) for (part, n), end in zip(found, ends, strict=True)]
    return frame.sparkSession.createDataFrame(rows, "part int, base long"), ends[-1] if ends else 0


def levels(rows: DataFrame, dims: int, bits: int) -> DataFrame:
    """``dim, num, txt, level`` of each distinct value of the columns ``k0, k1, ...``."""
    values = (rows.select(F.explode(F.array(*[F.col(f"k{i}") for i in range(dims)])).alias("k"))
              .select("k.*").groupBy("dim", "num", "txt").agg(F.count(F.lit(1)).alias("n")))
    sorted_ = ranked(values, "dim", "num", "txt")
    base, total = bases(sorted_, F.col("n"))
    each = max(1, total // dims)  # every column has a value in every row
    own = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("base") + F.coalesce(F.sum("n").over(own), F.lit(0)) - F.col("dim") * F.lit(each)
    return (sorted_.withColumn("part", F.shiftright("at", PLACE).cast("int")).join(F.broadcast(base), "part")
            .withColumn("before", before)
            .select("dim", "num", "txt", F.expr(f"before * {1 << bits}L div {each}L").cast("int").alias("level")))


def place(rows: DataFrame, dims: int, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """The rows (``row``, any ids, ``k0, k1, ...``) with ``curve, l0, l1, ..., shard, slot``;
    shards hold equally many rows, the first ones one more. Only columns named here may clash."""
    scale = materialize(levels(rows, dims, bits), "levels")
    for i in range(dims):
        own = scale.where(F.col("dim") == i).select(F.col("num").alias("_num"), F.col("txt").alias("_txt"), F.col("level").alias(f"l{i}"))
        rows = rows.join(own, F.col(f"k{i}.num").eqNullSafe(F.col("_num")) & F.col(f"k{i}.txt").eqNullSafe(F.col("_txt"))).drop("_num", "_txt")
    names = [*rows.columns, "curve"]

    def run(batches):
        for b in batches:
            cell = [b.column(f"l{i}").to_numpy(zero_copy_only=False) for i in range(dims)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hilbert(cell, bits), pa.int64())], names=names)

    curved = rows.mapInArrow(run, rows.select("*", F.lit(0).cast("long").alias("curve")).schema)
    sorted_ = ranked(curved, "curve", "doc_id", "size", "text_crc32", "row")
    base, total = bases(sorted_, F.lit(1))
    small, more = divmod(total, shards)
    in_first = more * (small + 1)  # rows of the shards that hold one more
    rank = F.col("base") + F.col("at").bitwiseAND(F.lit((1 << PLACE) - 1))
    shard = F.expr(f"CASE WHEN rank < {in_first} THEN rank div {small + 1}L ELSE {more} + (rank - {in_first}) div {max(1, small)}L END")
    start = F.col("shard") * small + F.least(F.col("shard"), F.lit(more))
    return (sorted_.withColumn("part", F.shiftright("at", PLACE).cast("int")).join(F.broadcast(base), "part")
            .withColumn("rank", rank).withColumn("shard", shard.cast("int"))
            .withColumn("slot", (F.col("rank") - start).cast("long")).drop("part", "base", "at", "rank"))


def measured(docs: DataFrame, id_col: str, text_col: str, dims: tuple[str, ...]) -> Column:
    """``doc_id, size, text_crc32, k0, k1, ...`` of a row, a struct: what placing needs."""
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    return F.struct(F.col(f"`{id_col}`").cast("long").alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
                    F.crc32(body).alias("text_crc32"), *[_key(docs, d, i).alias(f"k{i}") for i, d in enumerate(dims)])


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dims: tuple[str, ...] = DIMS,
          shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, k0, ..., l0, ..., curve, shard, slot``.

    ``size`` is the text's bytes in UTF-8 plus 1, a null text has none (and the
    checksum of an empty one). Null ids and null metadata come first in their
    order. Repeated rows are placed each. With fewer rows than shards the last
    shards are empty; an empty table gives no rows. Other columns are not read.
    A narrow row (no text) is written three times under the shared folder."""
    if shards < 1 or not dims or not 1 <= bits * len(dims) <= 62:
        raise ValueError("shards, dims and bits must be positive, with 62 bits at most together")
    rows = materialize(docs.select(measured(docs, id_col, text_col, dims).alias("m")).select("m.*", F.monotonically_increasing_id().alias("row")), "measured")
    return place(rows, len(dims), shards, bits).drop("row")


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", dims: tuple[str, ...] = DIMS,
          shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Writes the whole rows to ``path/shard=<n>`` as a struct ``doc``, in the order
    of their slots, and returns the shards' ``ranges``. Columns may have any names."""
    whole = materialize(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                                    measured(docs, id_col, text_col, dims).alias("m"),
                                    F.monotonically_increasing_id().alias("row")), "whole")
    placed = materialize(place(whole.select("m.*", "row"), len(dims), shards, bits), "placed")
    (whole.select("doc", "row").join(placed.select("row", "shard", "slot"), "row")
     .repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot").select("doc", "shard")
     .write.partitionBy("shard").parquet(path))
    return ranges(placed, dims)


def ranges(placed: DataFrame, dims: tuple[str, ...]) -> DataFrame:
    """``shard, n_rows, n_bytes, low_<dim>, high_<dim>, ...``: the box that each
    shard covers (values as ``num`` or ``txt``; nulls are the lowest)."""
    box = [f(F.col(f"k{i}")).alias(f"{n}_{d}") for i, d in enumerate(dims) for n, f in (("low", F.min), ("high", F.max))]
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("n_bytes"), *box)


def prune(boxes: DataFrame, wanted: dict[str, tuple]) -> DataFrame:
    """The shards that may hold rows whose columns lie in the wanted ranges (both ends count)."""
    for dim, (low, high) in wanted.items():
        part = "txt" if isinstance(low, str) else "num"
        least, most = F.col(f"`low_{dim}`.{part}"), F.col(f"`high_{dim}`.{part}")
        boxes = boxes.where((most >= low) & (least.isNull() | (least <= high)))
    return boxes
