"""A written index of the ids that were published, for incremental loads.

Ids are dealt by hash into buckets that hold a bounded number each; a bucket's
file is sorted, and beside it stands a Bloom filter. A load asks the filters
first: an id that no filter knows is new, and no file is opened for it. Only the
buckets of the ids that may have been seen are read (the folder name is the
bucket, so the others are pruned), and only those ids are compared. The
published layer itself is never read or shuffled.

Each load adds a segment. A segment counts once its row is in the list of
segments, which is written last; what a failed load leaves behind is not read,
and an id that was added twice does no harm. ``compact`` makes one segment of all.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids a bucket holds at first, on average; bits an id, and how many of them it sets (1 % false answers).
PER_BUCKET, BITS, HASHES = 2_000_000, 10, 7
#: Ids whose places a task holds at once.
AT_ONCE = 1 << 16
SEGMENTS = "segment string, n long, buckets int, replaces array<string>"


def _hashes(id_col: Column) -> list[Column]:
    return [F.xxhash64(id_col).alias("h1"), F.xxhash64(id_col, F.lit(1)).alias("h2")]


def _bucket(id_col: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(id_col, F.lit(2)), F.lit(buckets)).cast("int")


def _places(h1: np.ndarray, h2: np.ndarray, size: int) -> np.ndarray:
    """The bits of each id (ids, HASHES) in a filter of ``size`` bits."""
    steps = np.arange(HASHES, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return (h1.view(np.uint64)[:, None] + steps * (h2.view(np.uint64) | np.uint64(1))[:, None]) % np.uint64(size)


def bloom(h1: np.ndarray, h2: np.ndarray) -> bytes:
    size = max(64, -(-len(h1) * BITS // 8) * 8)
    bits = np.zeros(size, bool)
    for i in range(0, len(h1), AT_ONCE):
        bits[_places(h1[i:i + AT_ONCE], h2[i:i + AT_ONCE], size).ravel()] = True
    return np.packbits(bits).tobytes()


def may_hold(data: bytes, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Which ids the filter may hold; an id that it holds is never missed."""
    held = np.frombuffer(data, np.uint8)
    out = np.empty(len(h1), bool)
    for i in range(0, len(h1), AT_ONCE):
        at = _places(h1[i:i + AT_ONCE], h2[i:i + AT_ONCE], 8 * len(held))
        out[i:i + AT_ONCE] = ((held[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1).all(1)
    return out


@dataclass
class IdIndex:
    """The index in folder ``path`` (any file system that Spark reads)."""

    spark: SparkSession
    path: str

    def segments(self) -> list[tuple[str, int]]:
        """``segment, buckets`` of what counts now (one row a load)."""
        try:
            rows = self.spark.read.schema(SEGMENTS).parquet(f"{self.path}/segments").collect()
        except Exception as e:  # noqa: BLE001 - no load yet
            if "PATH_NOT_FOUND" in str(e):
                return []
            raise
        gone = {s for r in rows for s in r.replaces}
        return sorted((r.segment, r.buckets) for r in rows if r.segment not in gone)

    def add(self, ids: DataFrame, id_col: str, per_bucket: int = PER_BUCKET, replaces: tuple[str, ...] = ()) -> str | None:
        """A segment of the distinct ids (nulls are no ids); None if there is none."""
        known = self.segments()
        distinct = ids.select(F.col(f"`{id_col}`").cast("string").alias("id")).where("id is not null").distinct()
        n = distinct.count()
        if not n:
            return None
        # buckets never get fewer, so that a bucket stays small as segments are merged
        buckets = max(1, math.ceil(n / per_bucket), *(b for _, b in known))
        segment = uuid.uuid4().hex[:12]
        (distinct.withColumn("bucket", _bucket(F.col("id"), buckets)).repartition("bucket").sortWithinPartitions("bucket", "id")
         .write.partitionBy("bucket").parquet(f"{self.path}/ids/segment={segment}"))

        def build(group):
            h1, h2 = (group.column(c).to_numpy() for c in ("h1", "h2"))
            return pa.table([pa.array([bloom(h1, h2)], pa.binary()), pa.array([group.column("bucket")[0].as_py()], pa.int32())],
                            names=["bits", "bucket"])

        written = self.spark.read.schema("id string, bucket int").parquet(f"{self.path}/ids/segment={segment}")
        (written.select("bucket", *_hashes(F.col("id"))).groupBy("bucket").applyInArrow(build, "bits binary, bucket int")
         .write.parquet(f"{self.path}/filters/segment={segment}"))
        row = self.spark.createDataFrame([(segment, n, buckets, list(replaces))], SEGMENTS)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/segments")
        return segment

    def candidates(self, ids: DataFrame, id_col: str, segment: str, buckets: int, per_bucket: int = PER_BUCKET) -> DataFrame:
        """``id, bucket`` of the distinct ids that the segment's filters may hold. A
        load that is larger than the segment asks each filter in several parts, so
        that a task's ids stay about ``per_bucket``."""
        parts = max(1, math.ceil(ids.count() / (per_bucket * buckets)))
        asked = ids.select(F.col(f"`{id_col}`").cast("string").alias("id")).where("id is not null").distinct()
        asked = asked.withColumn("bucket", _bucket(F.col("id"), buckets)).select("id", "bucket", *_hashes(F.col("id")))
        filters = self.spark.read.schema("bits binary, bucket int").parquet(f"{self.path}/filters/segment={segment}")
        filters = filters.select("bits", F.col("bucket").alias("of"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("of_part"))
        asked = asked.withColumn("part", F.pmod(F.xxhash64(F.col("id"), F.lit(3)), F.lit(parts)).cast("int"))

        def test(group, bits):
            if not group.num_rows or not bits.num_rows:
                return group.select(["id", "bucket"]).slice(0, 0)
            h1, h2 = (group.column(c).to_numpy() for c in ("h1", "h2"))
            return group.select(["id", "bucket"]).filter(pa.array(may_hold(bits.column("bits")[0].as_py(), h1, h2)))

        return asked.groupBy("bucket", "part").cogroup(filters.groupBy("of", "of_part")).applyInArrow(test, "id string, bucket int")

    def stored(self, segment: str, wanted: list[int]) -> DataFrame:
        """``id, bucket`` of the segment's wanted buckets; no other file is read."""
        ids = self.spark.read.schema("id string, bucket int").parquet(f"{self.path}/ids/segment={segment}")
        return ids.where(F.col("bucket").isin(wanted))

    def seen(self, ids: DataFrame, id_col: str, keep=None) -> DataFrame:
        """``id``: the distinct ids that were added before. ``keep`` writes the few
        candidates (``session.materialize`` by default)."""
        from txwatch.session import materialize
        keep = keep or (lambda df: materialize(df, "candidates"))
        out = self.spark.createDataFrame([], "id string")
        for segment, buckets in self.segments():
            found = keep(self.candidates(ids, id_col, segment, buckets))
            wanted = sorted(r.bucket for r in found.select("bucket").distinct().collect())  # at most one number a bucket
            if wanted:
                out = out.unionByName(found.join(self.stored(segment, wanted), ["bucket", "id"], "left_semi").select("id"))
        return out.distinct()

    def split(self, rows: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
        """``(new, seen)`` rows with their columns; a row without an id is new."""
        own = "_"
        while any(c.startswith(own) for c in rows.columns):
            own += "_"
        seen = self.seen(rows, id_col).withColumnRenamed("id", own)
        same = F.col(f"`{id_col}`").cast("string") == F.col(own)
        return rows.join(seen, same, "left_anti"), rows.join(seen, same, "left_semi")

    def compact(self) -> str | None:
        """One segment in place of all (their files stay until their owner removes them)."""
        names = [s for s, _ in self.segments()]
        if len(names) < 2:
            return names[0] if names else None
        ids = self.spark.read.schema("id string, segment string, bucket int").parquet(f"{self.path}/ids")
        return self.add(ids.where(F.col("segment").isin(names)), "id", replaces=tuple(names))
