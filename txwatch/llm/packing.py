"""Packing of token sequences, shortest pack first over the length histogram.

A document's ids are cut into pieces of ``size`` and one remainder. Full pieces
are sequences of their own. The remainders are packed by their histogram alone
(at most ``size`` numbers, whatever the corpus): lengths are placed longest
first, each on the fullest kind of pack that has room (the shortest remaining
space), and the counts of the pack kinds are updated, not single packs. A kind
becomes a pattern, a list of lengths; patterns are joined back to the documents
by each remainder's rank among those of its length.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwatch.llm.tokens import encode
from txwatch.session import materialize

SIZE, END = 2048, 1
#: Rows of one length and salt that a task ranks, on average; bytes of ids in one batch of pieces.
RANKED, HELD = 100_000, 4 << 20


def pack_histogram(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, list[tuple[int, int]]]]:
    """``(packs, [(length, times), ...])``: patterns that place every length ``counts`` times."""
    open_: dict[int, list[tuple[int, list]]] = defaultdict(list)  # kinds of packs by the space they have left
    for length in sorted(counts, reverse=True):
        left, space = counts[length], length
        while left:
            while space <= size and not open_[space]:
                space += 1
            packs, runs = open_[space].pop() if space <= size else (left, [])
            room = min(space, size)
            times = min(room // length, left)
            used = min(packs, left // times)
            if runs and packs > used:
                open_[space].append((packs - used, runs))
            open_[room - times * length].append((used, [*runs, (length, times)]))
            left -= used * times
    return [(packs, runs) for kinds in open_.values() for packs, runs in kinds]


def slots(patterns: list[tuple[int, list[tuple[int, int]]]], first: int) -> np.ndarray:
    """``length, low`` (first rank)``, times, sequence`` (of that rank)``, offset`` for
    each run of each pattern, sorted: a few thousand rows, whatever the corpus."""
    out, rank = [], defaultdict(int)
    for packs, runs in patterns:
        offset = 0
        for length, times in runs:
            out.append((length, rank[length], times, first, offset))
            rank[length] += packs * times
            offset += length * times
        first += packs
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
           end: int = END) -> DataFrame:
    """``doc_id, start, length, doc_tokens, ids`` (little-endian 32-bit) of every
    piece; the documents' ids end with ``end``."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    names = ["doc_id", "start", "length", "doc_tokens", "ids"]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.binary())],
                                          names=names)

    def run(batches):
        for b in batches:
            rows, held = [], 0
            for doc, text in zip(b.column("doc_id"), b.column("text"), strict=True):
                ids = np.append(encode(path, text.as_py()), np.uint32(end)).astype("<u4")
                rows += [(doc.as_py(), at, len(part := ids[at:at + size]), len(ids), part.tobytes())
                         for at in range(0, len(ids), size)]
                held += 4 * len(ids)
                if held >= HELD:
                    yield table(rows)
                    rows, held = [], 0
            if rows:
                yield table(rows)

    return narrow.mapInArrow(run, "doc_id long, start long, length long, doc_tokens long, ids binary")


def place(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """``row, sequence_id, offset`` of the rows of ``cut`` (a distinct ``row`` and
    a ``length`` up to ``size``). Only the histogram reaches the driver."""
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # rank within a length: within salts first, so that no length is one task
    n_salts = F.array(*[F.lit(-(-counts.get(k, 1) // RANKED)) for k in range(1, size + 1)])
    salted = cut.select("row", "length", F.pmod(F.xxhash64("row"), F.element_at(n_salts, F.col("length").cast("int"))).alias("salt"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = (salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
            .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("row")) - 1
    ranked = (salted.withColumn("own", own).join(base, ["length", "salt"])
              .select("row", "length", (F.col("base") + F.col("own")).alias("rank")))
    n_full = counts.pop(size, 0)
    known = np.concatenate([slots(pack_histogram(counts, size), n_full), [[size, 0, 1, 0, 0]]])
    # a run covers a range of ranks: the last run of the length that starts at or below the rank
    key = known[:, 0] << 44 | known[:, 1]

    def find(batches):
        for b in batches:
            row, length, rank = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("row", "length", "rank"))
            run = known[np.searchsorted(key, length << 44 | rank, side="right") - 1]
            turn, slot = np.divmod(rank - run[:, 1], run[:, 2])
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(run[:, 3] + turn), pa.array(run[:, 4] + slot * length)],
                                             names=["row", "sequence_id", "offset"])

    return ranked.mapInArrow(find, "row long, sequence_id long, offset long")


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
         end: int = END, value: Column | None = None) -> DataFrame:
    """One row a piece: ``doc_id, start, length, doc_tokens, ids, sequence_id, offset``.

    ``value``, an expression of ``ids``, travels in place of the ids if only that
    is wanted. A null or empty text is one piece with the end id. Repeated rows
    are packed each. An empty table gives no rows. Other columns are not read.
    The pieces are written once under the shared folder."""
    if size < 1:
        raise ValueError("size must be positive")
    value = F.col("ids") if value is None else value
    cut = materialize(pieces(docs, path, id_col, text_col, size, end)
                      .select("doc_id", "start", "length", "doc_tokens", value)
                      .withColumn("row", F.monotonically_increasing_id()), "pieces")
    return cut.join(place(cut.select("row", "length"), size), "row").drop("row")
