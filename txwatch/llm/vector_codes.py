"""Vector codes of a product quantiser, fitted with adaptive lower bounds.

A vector's components become integers and it is cut into equal parts; each part
position has a codebook. A pass over the vectors gives every part its nearest
entry. Besides the entry, a part keeps an upper bound of its distance, its ``b``
closest other entries with ordered lower bounds, and one outer lower bound for
all the rest; they are written with the vector, so a lost executor costs one
pass. When the entries move, the bounds move with them (their own entry's step
up, the listed ones' steps down, the outer one by the largest step), and only a
part whose bounds no longer part its entry from the others is compared again:
with its own entry first, then with the listed entries within reach, and with
all entries only if the outer bound is in reach as well. These comparisons are
in integers, so ties go to the lower index exactly. After each pass ``b``
shrinks to what settled nearly all compared parts.

Spark sums what changed places (at most entries x components numbers a task);
the codebooks are all that the driver holds.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch.session import scratch_path

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Entries listed at first and at least; share of the compared parts that the list must settle.
LISTED, LEAST, SETTLED = 8, 2, 0.9
#: Components are held within this bound, so that all distances are exact in 64 bits.
BOUND = 1 << 24
#: Integers that a comparison holds at once.
HELD = 1 << 21
F32 = np.float32


@dataclass
class Codes:
    """``frame``: ``vec_id, label, code`` (one byte a part)``, error`` (squared
    distance over the parts); ``codebooks``: (entries, components) of each part."""

    frame: DataFrame
    codebooks: list[np.ndarray]

    def sha256(self) -> str:
        """Of all entries' components in decimal, joined by commas."""
        return hashlib.sha256(",".join(str(x) for book in self.codebooks for x in book.ravel().tolist()).encode()).hexdigest()

    def decode(self, code: bytes) -> np.ndarray:
        """The integer vector that a code stands for."""
        return np.concatenate([book[c] for book, c in zip(self.codebooks, code, strict=True)])


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(F32), F32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(F32), F32(-np.inf))


def squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows, entries)."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    kind = np.float64 if 4 * most * most * x.shape[1] < 1 << 53 else np.int64  # both exact; floats are faster
    a, c = x.astype(kind), book.astype(kind)
    return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)


def state_type(b: int, parts: int) -> np.dtype:
    return np.dtype([("code", "u1", parts), ("was", "u1", parts), ("used", "u1", parts), ("up", "f4", parts),
                     ("out", "f4", parts), ("near", "u1", (parts, b)), ("low", "f4", (parts, b))])


def search(x: np.ndarray, book: np.ndarray, b: int):
    """``code, up, out, near, low`` of rows compared with every entry."""
    d = squares(x, book)
    rows = np.arange(len(x))
    code = d.argmin(1)  # the first of equal ones
    up = _up(np.sqrt(d[rows, code]))
    d[rows, code] = np.iinfo(np.int64).max
    if b < len(book) - 1:
        near = np.argpartition(d, b, axis=1)[:, :b + 1]
        near = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1, kind="stable"), 1)
        out = _down(np.sqrt(np.take_along_axis(d, near[:, b:], 1)[:, 0]))
        near = near[:, :b]
    else:
        near, out = np.argsort(d, axis=1, kind="stable")[:, :b], np.full(len(x), np.inf, F32)
    return code, up, out, near, _down(np.sqrt(np.take_along_axis(d, near, 1)))


def ordered(near: np.ndarray, low: np.ndarray):
    order = np.argsort(low, axis=1, kind="stable")
    return np.take_along_axis(near, order, 1), np.take_along_axis(low, order, 1)


def update(x: np.ndarray, book: np.ndarray, step: np.ndarray, code, up, out, near, low):
    """New ``code, up, out, near, low`` and the listed entries used, of rows whose
    entries moved by ``step`` (upper bounds) to ``book``; all right for any row."""
    b = near.shape[1]
    up = _up(up + step[code])
    out = _down(out - step.max(initial=0))
    near, low = ordered(near, _down(low - step[near]))
    used = np.zeros(len(x), np.int64)
    reach = lambda k: up[k] >= np.minimum(out[k], low[k, 0] if b else np.inf)
    todo = np.flatnonzero(reach(slice(None)))
    up[todo] = _up(np.sqrt(((x[todo] - book[code[todo]]) ** 2).sum(1)))
    todo = todo[reach(todo)]
    for at in range(0, len(todo), max(1, HELD // max(1, (b + 1) * x.shape[1]))):
        k = todo[at:at + max(1, HELD // max(1, (b + 1) * x.shape[1]))]
        used[k] = (low[k] <= up[k, None]).sum(1)
        listed = np.concatenate([code[k, None], near[k]], axis=1)
        d = ((x[k, None, :] - book[listed]) ** 2).sum(2)
        best = np.lexsort((listed, d), axis=1)[:, 0]  # the least distance, then the lower index
        first = np.take_along_axis(listed, best[:, None], 1)[:, 0]
        up[k] = _up(np.sqrt(np.take_along_axis(d, best[:, None], 1)[:, 0]))
        # the entry that lost its place takes that of the one that won
        np.put_along_axis(listed, best[:, None], code[k, None], 1)
        np.put_along_axis(d, best[:, None], d[:, :1].copy(), 1)
        code[k] = first
        near[k], low[k] = ordered(listed[:, 1:], _down(np.sqrt(d[:, 1:])))
    far = todo[up[todo] >= out[todo]]
    for at in range(0, len(far), max(1, HELD // len(book))):
        k = far[at:at + max(1, HELD // len(book))]
        used[k] = b + 1
        code[k], up[k], out[k], near[k], low[k] = search(x[k], book, b)
    return code, up, out, near, low, used


def shorter(state: np.ndarray, b: int, parts: int) -> np.ndarray:
    """The state with ``b`` listed entries; the outer bound takes the others in."""
    out = np.empty(len(state), state_type(b, parts))
    for name in ("code", "was", "used", "up", "out"):
        out[name] = state[name]
    out["near"], out["low"] = state["near"][..., :b], state["low"][..., :b]
    if state["low"].shape[2] > b:
        out["out"] = np.minimum(state["out"], state["low"][..., b:].min(2))
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary value for each row of a contiguous array."""
    each = rows.nbytes // len(rows) if len(rows) else 0
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(each)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _rows(column: pa.Array, dtype: np.dtype) -> np.ndarray:
    """The values of a binary column of equal lengths, as one array."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def vectors(frame: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """``vec_id, label, v``: the kept rows' integer components."""
    x = F.col(vec_col)
    sound = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform(x, lambda c: F.greatest(F.lit(float(-BOUND)), F.least(F.lit(float(BOUND)), F.floor(c.cast("double") * scale).cast("double"))).cast("long"))
    return frame.where(F.coalesce(sound, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), whole.alias("v"))


def _matrix(column: pa.ListArray, width: int, dtype: np.dtype) -> np.ndarray:
    """Lists as rows of ``width``, made up with zeros."""
    size = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy()
    out = np.zeros((len(size), width), dtype)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _written(frame: DataFrame, last: str | None) -> tuple[DataFrame, str]:
    """``frame`` as a table under the shared folder; the one it was made from goes."""
    spark, path = frame.sparkSession, scratch_path(frame.sparkSession, "vector-codes")
    frame.write.parquet(path)
    if last is not None:
        place = spark._jvm.org.apache.hadoop.fs.Path(last)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return spark.read.parquet(path), path


def _assigned(rows: DataFrame, books: list[np.ndarray], b: int, width: int, dtype: np.dtype, label: str) -> DataFrame:
    """The first pass: every part against every entry."""
    parts, kind = len(books), state_type(b, len(books))

    def run(batches):
        for batch in batches:
            v = _matrix(batch.column("v"), width, dtype)
            state = np.zeros(len(v), kind)
            for p, book in enumerate(books):
                x = np.split(v, parts, axis=1)[p].astype(np.int64)
                for at in range(0, len(v), max(1, HELD // len(book))):
                    k = slice(at, at + max(1, HELD // len(book)))
                    for name, value in zip(("code", "up", "out", "near", "low"), search(x[k], book, b), strict=True):
                        state[name][k, p] = value
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), _binary(v), _binary(state)],
                                             names=["vec_id", "label", "vec", "state"])

    return rows.mapInArrow(run, f"vec_id long, label {label}, vec binary, state binary")


def _moved(rows: DataFrame, old: list[np.ndarray], new: list[np.ndarray], was: int, b: int, width: int, dtype: np.dtype, label: str) -> DataFrame:
    """A later pass: bounds move with the entries, unsure parts are compared."""
    parts = len(new)
    steps = [_up(np.sqrt(((n - o) ** 2).sum(1))) for o, n in zip(old, new, strict=True)]

    def run(batches):
        for batch in batches:
            vec = batch.column("vec")
            v = _rows(vec, dtype).reshape(len(vec), width)
            state = shorter(_rows(batch.column("state"), state_type(was, parts)), b, parts)
            state["was"] = state["code"]
            for p, book in enumerate(new):
                x = np.split(v, parts, axis=1)[p].astype(np.int64)
                got = update(x, book, steps[p], *(state[name][:, p].astype(t) for name, t in (
                    ("code", np.int64), ("up", F32), ("out", F32), ("near", np.int64), ("low", F32))))
                for name, value in zip(("code", "up", "out", "near", "low", "used"), got, strict=True):
                    state[name][:, p] = value
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), vec, _binary(state)],
                                             names=["vec_id", "label", "vec", "state"])

    return rows.mapInArrow(run, f"vec_id long, label {label}, vec binary, state binary")


def _changes(rows: DataFrame, b: int, width: int, dtype: np.dtype, parts: int, entries: int, anew: bool):
    """What the parts that changed places add to each entry: ``(counts, sums)`` by
    part, and how many compared parts used how many listed entries; ``anew``: all parts add."""
    each = width // parts

    def run(batches):
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, each), np.int64)
        use = np.zeros(b + 2, np.int64)
        for batch in batches:
            vec = batch.column("vec")
            v = _rows(vec, dtype).reshape(len(vec), width)
            state = _rows(batch.column("state"), state_type(b, parts))
            use += np.bincount(state["used"].ravel(), minlength=b + 2)[:b + 2]
            for p in range(parts):
                x, code, was = np.split(v, parts, axis=1)[p].astype(np.int64), state["code"][:, p], state["was"][:, p]
                for sign, at in ((1, code),) if anew else ((1, code), (-1, was)):
                    k = np.flatnonzero((code != was) | anew)
                    np.add.at(counts[p], at[k], sign)
                    np.add.at(sums[p], at[k], sign * x[k])
        found = np.concatenate([counts[:, :, None], sums], axis=2)
        p, e, c = np.nonzero(found)
        u = np.flatnonzero(use)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(p, np.full(len(u), parts)), pa.int32()), pa.array(np.append(e, u), pa.int32()),
             pa.array(np.append(c, np.zeros(len(u), np.int64)), pa.int32()), pa.array(np.append(found[p, e, c], use[u]), pa.int64())],
            names=["part", "entry", "place", "n"])

    got = (rows.select("vec", "state").mapInArrow(run, "part int, entry int, place int, n long")
           .groupBy("part", "entry", "place").agg(F.sum("n").alias("n")).collect())
    counts, sums, use = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, each), np.int64), np.zeros(b + 2, np.int64)
    for r in got:
        if r.part == parts:
            use[r.entry] = r.n
        elif r.place:
            sums[r.part, r.entry, r.place - 1] = r.n
        else:
            counts[r.part, r.entry] = r.n
    return counts, sums, use


def listed_next(use: np.ndarray, b: int) -> int:
    """The list length that would have settled ``SETTLED`` of the compared parts
    that the list did settle, ``LEAST`` at least; it never grows."""
    done = np.cumsum(use[1:b + 1])
    if not len(done) or not done[-1]:
        return min(b, LEAST)
    return min(b, max(LEAST, int(np.searchsorted(done, SETTLED * done[-1])) + 1))


def fit(frame: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
        parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codes:
    """Codes of all kept rows and the codebooks after ``rounds`` updates.

    Rows whose vector is null or holds null, NaN or infinite components go.
    Integer components beyond 2**24 are held there. Shorter vectors are made up
    with zeros to the longest one, and to a multiple of ``parts``. The first
    entries are the vectors of the ``entries`` smallest distinct ids (of repeated
    ids the least vector; a null id comes last); fewer rows give fewer entries.
    Repeated rows are coded each. An empty table gives no rows and no entries;
    other columns are not read."""
    spark: SparkSession = frame.sparkSession
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte a part")
    kept = vectors(frame, id_col, vec_col, label_col, scale)
    label = kept.schema["label"].dataType.simpleString()
    span = kept.agg(F.max(F.size("v")).alias("width"), F.max(F.array_max("v")).alias("most"), F.min(F.array_min("v")).alias("least")).first()
    if span.width is None:
        return Codes(spark.createDataFrame([], f"vec_id long, label {label}, code binary, error long"), [])
    width = max(parts, -(-span.width // parts) * parts)
    dtype = np.dtype(np.int16 if max(span.most or 0, -(span.least or 0)) < 1 << 15 else np.int32)
    by_id = F.col("vec_id").asc_nulls_last()
    ids = [r.vec_id for r in kept.select("vec_id").distinct().orderBy(by_id).limit(entries).collect()]
    last = max((i for i in ids if i is not None), default=None)
    reach = F.col("vec_id").isNull() if None in ids else F.lit(False)
    first = (kept.where(reach | F.coalesce(F.col("vec_id") <= F.lit(last), F.lit(False))).groupBy("vec_id")
             .agg(F.min("v").alias("v")).orderBy(by_id).collect())
    start = np.zeros((len(first), width), np.int64)
    for row, r in zip(start, first, strict=True):
        row[:len(r.v)] = r.v
    books = [np.ascontiguousarray(x) for x in np.split(start, parts, axis=1)]

    b = min(LISTED, len(first) - 1)
    rows, path = _written(_assigned(kept, books, b, width, dtype, label), None)
    counts = np.zeros((parts, len(first)), np.int64)
    sums = np.zeros((parts, len(first), width // parts), np.int64)
    for k in range(rounds):
        more, added, use = _changes(rows, b, width, dtype, parts, len(first), k == 0)
        counts, sums = counts + more, sums + added
        new = [np.where(n[:, None] > 0, s // np.maximum(n, 1)[:, None], old)
               for n, s, old in zip(counts, sums, books, strict=True)]
        was, b = b, listed_next(use, b) if k else b
        rows, path = _written(_moved(rows, books, new, was, b, width, dtype, label), path)
        books = new

    kind = state_type(b, parts)

    def finish(batches):
        for batch in batches:
            vec = batch.column("vec")
            v = _rows(vec, dtype).reshape(len(vec), width).astype(np.int64)
            code = _rows(batch.column("state"), kind)["code"]
            error = np.zeros(len(v), np.int64)
            for p, book in enumerate(books):
                error += ((np.split(v, parts, axis=1)[p] - book[code[:, p]]) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), _binary(code.astype(np.uint8)),
                                              pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    return Codes(rows.mapInArrow(finish, f"vec_id long, label {label}, code binary, error long"), books)


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the error summed over equal labels (nulls together)."""
    total = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return coded.join(total, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
