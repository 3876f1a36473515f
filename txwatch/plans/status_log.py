"""The alerts' status log as a snapshot and a tail.

Changes are appended in segments. What counts is the list of segments that the
current version names (``versions``), together with a snapshot: the latest valid
change of every alert in the segments that it replaced. The latest change is a
maximum, so a snapshot and the changes behind it give what the whole log gives,
in whatever order changes come and however often; a change that comes late is
just one more row of the tail. Reading the state never replays the log.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch import schemas as S
from txwatch.operators.alerts import normalize_changes
from txwatch.plans.versions import Conflict, VersionedLayer

CHANGE = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.STATUS_CHANGE_SCHEMA.fields)


def latest_changes(changes: DataFrame) -> DataFrame:
    """The latest valid change of each alert (of equally late ones the greater status)."""
    valid = normalize_changes(changes).where(F.col("status").isin(*S.ALERT_STATUSES))
    last = F.max(F.struct("changed_at", "status")).alias("last")
    return valid.groupBy("alert_id").agg(last).select("alert_id", "last.status", "last.changed_at")


@dataclass
class StatusLog:
    spark: SparkSession
    path: str
    versions: VersionedLayer = field(init=False)

    def __post_init__(self):
        self.versions = VersionedLayer(self.spark, self.path)

    def _entry(self) -> tuple[int, dict]:
        return self.versions.current() or (0, {"snapshot": None, "tail": []})

    def _read(self, folders: list[str]) -> DataFrame:
        read = self.spark.read.schema(CHANGE)
        return read.parquet(*[f"{self.path}/{f}" for f in folders]) if folders else self.spark.createDataFrame([], CHANGE)

    def append(self, changes: DataFrame) -> int:
        """The number of the version that has these changes behind all others."""
        folder = f"log/{uuid.uuid4().hex}"
        changes.select(*[F.col(f.name).cast(f.dataType) for f in S.STATUS_CHANGE_SCHEMA.fields]).write.parquet(f"{self.path}/{folder}")
        while True:
            at, entry = self._entry()
            try:
                return self.versions.commit({"snapshot": entry["snapshot"], "tail": [*entry["tail"], folder]}, expected=at)
            except Conflict:
                continue  # someone else appended or compacted: behind that

    def compact(self) -> int:
        """A snapshot in place of the segments that are there now; what is appended meanwhile stays the tail."""
        _, seen = self._entry()
        folder = f"snapshots/{uuid.uuid4().hex}"
        latest_changes(self._read(self._parts(seen))).write.parquet(f"{self.path}/{folder}")
        while True:
            at, entry = self._entry()
            if entry["snapshot"] != seen["snapshot"]:
                return at  # another compaction was faster
            try:
                return self.versions.commit({"snapshot": folder, "tail": [t for t in entry["tail"] if t not in seen["tail"]]}, expected=at)
            except Conflict:
                continue

    @staticmethod
    def _parts(entry: dict) -> list[str]:
        return [*([entry["snapshot"]] if entry["snapshot"] else []), *entry["tail"]]

    def parts(self) -> list[str]:
        """The folders that a reader of the state opens: the snapshot and the tail."""
        return self._parts(self._entry()[1])

    def latest(self) -> DataFrame:
        """``alert_id, status, changed_at``: each alert's latest valid change."""
        return latest_changes(self._read(self.parts()))
