"""A keyed exchange between batches, in whole arrays instead of rows.

A batch asks about many 64-bit keys (hashes). Its keys are deduplicated, cut
into buckets by their leading bits and sent as one binary value a bucket; each
bucket settles its keys over all batches and answers each batch that asked.
A key that a third of all documents share is one entry a batch, so no bucket
holds more than batches x 1 of it, and no pair of documents is ever formed.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

U = np.uint64
ASK = "bucket int, batch int, data binary"
ANSWER = "batch int, data binary"
_ASK = pa.schema([("bucket", pa.int32()), ("batch", pa.int32()), ("data", pa.binary())])
_ANSWER = pa.schema([("batch", pa.int32()), ("data", pa.binary())])


def packed(entries: np.ndarray) -> bytes:
    """The bytes of the entries, plane by plane: leading bytes of sorted hashes
    and of small numbers stand together, where the shuffle's codec shrinks them."""
    size = entries.dtype.itemsize
    return np.ascontiguousarray(entries).view(np.uint8).reshape(-1, size).T.tobytes()


def unpacked(value: bytes, dtype: np.dtype) -> np.ndarray:
    planes = np.frombuffer(value, np.uint8).reshape(dtype.itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def cut(batch: int, entries: np.ndarray, key: str, n_buckets: int) -> pa.Table:
    """One row for each bucket that gets entries (a structured array sorted by ``key``)."""
    bucket = ((entries[key] >> U(32)) * U(n_buckets) >> U(32)).astype(np.int64)
    at = np.flatnonzero(np.diff(bucket, prepend=-1)) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(at, len(bucket))[1:]
    return pa.table([pa.array(bucket[at], pa.int32()), pa.array([batch] * len(at), pa.int32()),
                     pa.array([packed(entries[a:b]) for a, b in zip(at, ends, strict=True)], pa.binary())],
                    schema=_ASK)


def joined(values, dtype: np.dtype) -> np.ndarray:
    """The entries of all binary values, in their order."""
    return np.concatenate([np.empty(0, dtype), *(unpacked(v, dtype) for v in values)])


def settle(asked: DataFrame, dtype: np.dtype,
           answer: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """``answer(entries, sender)`` sees all entries of a bucket and the row each
    came in; it returns the entries to send back and the row each goes to."""

    def run(group):
        values = group.column("data").to_pylist()
        entries = joined(values, dtype)
        sender = np.repeat(np.arange(len(values)), [len(v) // dtype.itemsize for v in values])
        back, to = answer(entries, sender)
        order = np.argsort(to, kind="stable")
        back, to = back[order], to[order]
        rows, at = np.unique(to, return_index=True)
        ends = np.append(at, len(to))[1:]
        batches = group.column("batch").to_pylist()
        return pa.table([pa.array([batches[r] for r in rows], pa.int32()),
                         pa.array([packed(back[a:b]) for a, b in zip(at, ends, strict=True)], pa.binary())],
                        schema=_ANSWER)

    return asked.groupBy("bucket").applyInArrow(run, ANSWER)
