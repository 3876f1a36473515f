"""Substring deduplication with difference-cover anchors.

A window of ``window`` words is a repeat if the same words also start in a
document with a smaller id; every word under a repeat is removed.

Hashing every window would move one entry a word. Instead, anchors of
``window - period + 1`` words are hashed only at positions whose remainder
modulo ``period`` is in a difference cover: for any two positions p and q there
is a shift s < period with both p + s and q + s in the cover, so two equal
windows, wherever they start, hold one anchor at the same shift. Passes:

1. each batch sends its distinct anchors; a bucket finds those that two
   documents share (a hot passage is one entry a batch);
2. each batch extends its shared anchors: the windows around them are the
   candidates, sent with the smallest id that has them; a bucket returns the
   smallest id over all batches;
3. each batch removes the words under windows whose smallest id is below the
   document's own.

Windows are compared by 96 bits of hash (anchors, which only propose, by 64).
The batches come from one exchange of the texts that all passes reuse.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch.llm.common import batched, free_prefix, n_parts, text_bytes
from txwatch.llm.exchange import ASK, cut, joined, settle
from txwatch.llm.hashing import U, window_hashes, word_hashes

WINDOW, PERIOD = 13, 7
BATCH_BYTES, BUCKET_BYTES = 16 << 20, 16 << 20
NO_ID = np.iinfo(np.int64).max

ANCHOR = np.dtype([("hash", U), ("multi", np.uint8)])
SPAN = np.dtype([("hash", U), ("hash2", np.uint32), ("low", np.int64), ("multi", np.uint8)])
OUT = "doc_id long, text_sha256 string, n_words long, n_removed long, kept_text string"
_OUT = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("n_words", pa.int64()),
                  ("n_removed", pa.int64()), ("kept_text", pa.string())])


def difference_cover(period: int) -> list[int]:
    """The smallest set of remainders whose differences are all remainders."""
    for size in range(1, period + 1):
        for rest in product(range(period), repeat=size - 1):
            cover = sorted({0, *rest})
            if len(cover) == size and len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    raise ValueError(period)


def _grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by the keys and where each group of equal keys starts in it."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    return order, np.flatnonzero(new)


def _spread(starts: np.ndarray, n: int) -> np.ndarray:
    return np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))


class _Batch:
    """The documents of one batch, hashed."""

    def __init__(self, group: pa.Table, window: int, period: int):
        self.ids = [NO_ID if i is None else i for i in group.column("doc_id").to_pylist()]
        self.window, self.k = window, window - period + 1
        self.period, self.cover = period, np.array(difference_cover(period))
        self.parts = [b.split() for b in group.column("body").to_pylist()]
        self.hashes = [word_hashes(p) for p in self.parts]

    def anchors(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        h = self.hashes[i]
        if len(h) < self.window:
            return np.zeros(0, np.int64), np.zeros(0, U)
        at = np.arange(len(h) - self.k + 1)
        at = at[np.isin(at % self.period, self.cover)]
        return at, window_hashes(h, self.k, at)

    def owners(self, arrays: list[np.ndarray]) -> np.ndarray:
        return np.repeat(np.array(self.ids, np.int64), [len(a) for a in arrays])


def send_anchors(batch: int, group: pa.Table, window: int, period: int, n_buckets: int) -> pa.Table:
    b = _Batch(group, window, period)
    found = [b.anchors(i)[1] for i in range(len(b.ids))]
    hashes, owner = np.concatenate([*found, np.zeros(0, U)]), b.owners(found)
    order, starts = _grouped(hashes)
    out = np.empty(len(starts), ANCHOR)
    if len(starts):
        owner = owner[order]
        out["hash"] = hashes[order][starts]
        out["multi"] = np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts)
    return cut(batch, out, "hash", n_buckets)


def shared_anchors(entries: np.ndarray, sender: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Back to each sender: its anchors that two documents have."""
    order, starts = _grouped(entries["hash"])
    if not len(starts):
        return np.zeros(0, U), sender
    several = np.diff(np.append(starts, len(order))) > 1
    several |= np.maximum.reduceat(entries["multi"][order], starts) > 0
    hit = order[several[_spread(starts, len(order))]]
    return entries["hash"][hit], sender[hit]


def send_spans(group: pa.Table, answers: pa.Table, window: int, period: int, n_buckets: int) -> pa.Table:
    if not group.num_rows or not answers.num_rows:
        return cut(0, np.empty(0, SPAN), "hash", n_buckets)
    batch = group.column("batch")[0].as_py()
    shared = np.sort(joined(answers.column("data").to_pylist(), np.dtype(U)))
    b = _Batch(group, window, period)
    first, second = [], []
    for i, h in enumerate(b.hashes):
        at, hashes = b.anchors(i)
        if len(at):
            near = np.minimum(np.searchsorted(shared, hashes), len(shared) - 1)
            at = at[shared[near] == hashes]
        if not len(at):
            first.append(np.zeros(0, U))
            second.append(np.zeros(0, U))
            continue
        # extend: a window holds the anchor if it starts less than `period` words before it
        n = len(h) - window + 1
        cover = np.zeros(n + 1, np.int64)
        np.add.at(cover, np.clip(at - period + 1, 0, n), 1)
        np.add.at(cover, np.clip(at + 1, 0, n), -1)
        at = np.flatnonzero(np.cumsum(cover)[:n] > 0)
        first.append(window_hashes(h, window, at))
        second.append(window_hashes(h, window, at, second=True))
    h1, h2, owner = np.concatenate(first), np.concatenate(second).astype(np.uint32), b.owners(first)
    order, starts = _grouped(h1, h2)
    out = np.empty(len(starts), SPAN)
    if len(starts):
        owner = owner[order]
        out["hash"], out["hash2"] = h1[order][starts], h2[order][starts]
        out["low"] = np.minimum.reduceat(owner, starts)
        out["multi"] = out["low"] != np.maximum.reduceat(owner, starts)
    return cut(batch, out, "hash", n_buckets)


def lowest_ids(entries: np.ndarray, sender: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Back to each sender: its windows that a smaller id has than one of its own, with the smallest."""
    order, starts = _grouped(entries["hash"], entries["hash2"])
    if not len(starts):
        return entries, sender
    low = np.minimum.reduceat(entries["low"][order], starts)[_spread(starts, len(order))]
    keep = (low < entries["low"][order]) | (entries["multi"][order] > 0)
    back = entries[order[keep]].copy()
    back["low"] = low[keep]
    return back, sender[order[keep]]


def remove(group: pa.Table, answers: pa.Table, window: int, period: int) -> pa.Table:
    b = _Batch(group, window, period)
    known = joined(answers.column("data").to_pylist(), SPAN)
    known = known[np.lexsort((known["hash2"], known["hash"]))]
    rows = []
    for i, (parts, h) in enumerate(zip(b.parts, b.hashes, strict=True)):
        removed = 0
        if len(known) and len(h) >= window:
            h1 = window_hashes(h, window)
            at = np.searchsorted(known["hash"], h1)
            open_ = np.flatnonzero((at < len(known)) & (known["hash"][np.minimum(at, len(known) - 1)] == h1))
            if len(open_):
                h2 = window_hashes(h, window, open_, second=True).astype(np.uint32)
                at, h1 = at[open_], h1[open_]
                hits = []
                while len(open_):  # a second round only where two windows share their first 64 bits
                    same = known["hash2"][at] == h2
                    hits.append(open_[same & (known["low"][at] < b.ids[i])])
                    at = at + 1
                    more = ~same & (at < len(known)) & (known["hash"][np.minimum(at, len(known) - 1)] == h1)
                    open_, at, h1, h2 = open_[more], at[more], h1[more], h2[more]
                cover = np.zeros(len(h) + 1, np.int64)
                starts = np.concatenate(hits)
                cover[starts] += 1
                cover[starts + window] -= 1
                gone = np.cumsum(cover)[:len(h)] > 0
                removed = int(gone.sum())
                if removed:
                    parts = [parts[j] for j in np.flatnonzero(~gone)]
        rows.append((len(h), removed, b" ".join(parts).decode()))
    n, r, kept = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table([group.column("doc_id"), group.column("text_sha256"), pa.array(n, pa.int64()),
                     pa.array(r, pa.int64()), pa.array(kept, pa.string())], schema=_OUT)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    period: int = PERIOD, batch_bytes: int = BATCH_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per input row: ``doc_id, text_sha256`` (of the input text)``, n_words,
    n_removed, kept_text`` (the words that stay, joined by one space).

    A null text has no words. A null id compares as larger than any other.
    Rows that repeat an id do not remove from one another. An empty table gives
    no rows. Other columns are not read. ``batch_bytes`` and ``bucket_bytes``
    bound what a task holds at once; they change no result.
    """
    if not 1 <= period <= window:
        raise ValueError("period must be between 1 and window")
    spark = docs.sparkSession
    total = text_bytes(docs, text_col)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_batches, n_buckets = n_parts(total, batch_bytes, least), n_parts(total, bucket_bytes, least)
    rows = batched(docs, id_col, text_col, n_batches)
    hashed = rows.groupBy("batch")

    def first(key, group):
        return send_anchors(key[0].as_py(), group, window, period, n_buckets)

    def second(group, answers):
        return send_spans(group, answers, window, period, n_buckets)

    def last(group, answers):
        group = group.append_column("text_sha256", _digests(group))
        return remove(group, answers, window, period)

    shared = settle(hashed.applyInArrow(first, ASK), ANCHOR, shared_anchors)
    spans = hashed.cogroup(shared.groupBy("batch")).applyInArrow(second, ASK)
    lows = settle(spans, SPAN, lowest_ids)
    return hashed.cogroup(lows.groupBy("batch")).applyInArrow(last, OUT)


def _digests(group: pa.Table) -> pa.Array:
    from hashlib import sha256
    return pa.array([sha256(b).hexdigest() for b in group.column("body").to_pylist()], pa.string())


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text_col``; every row and
    column stays, whatever the names. A text that loses no word is left as it is
    (a null one too); repeated rows are cut alike. An empty table gives no rows."""
    own = free_prefix(docs.columns)
    at, sha, kept, digest = own + "id", own + "sha", own + "kept", own + "body"
    changed = (substring_dedup(docs, id_col, text_col, **options).where("n_removed > 0")
               .select(F.col("doc_id").alias(at), F.col("text_sha256").alias(sha), F.col("kept_text").alias(kept))
               .dropDuplicates([at, sha]))
    body = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)
    out = docs.withColumn(digest, body).join(
        changed, F.col(id_col).cast("long").eqNullSafe(F.col(at)) & (F.col(digest) == F.col(sha)), "left")
    return out.select(*[F.coalesce(F.col(kept), F.col(c)).alias(c) if c == text_col else F.col(f"`{c}`")
                        for c in docs.columns])
