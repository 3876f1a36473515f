"""Snapshot and tail equal a replay of the whole log, with late and repeated changes."""
import datetime as dt
import random

from txwatch.operators import alerts as A
from txwatch.plans import status_log as L

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "alert_id string, status string, changed_at timestamp_ntz"


def changes(seed, n, hours):
    rng = random.Random(seed)
    return [(f"a{rng.randint(0, 20)}", rng.choice(["open", " CLOSED", "INVESTIGATING", "ESCALATED", None]), T0 + dt.timedelta(hours=rng.randint(*hours))) for _ in range(n)]


def test_equals_a_replay(spark, tmp_path):
    log = L.StatusLog(spark, str(tmp_path / "log"))
    assert log.latest().count() == 0 and log.parts() == []
    alerts = spark.createDataFrame([(f"a{i}", "OPEN", None) for i in range(0, 24, 2)], "alert_id string, status string, updated_at timestamp_ntz")
    parts = [changes(1, 40, (50, 99)), changes(2, 40, (0, 60)), changes(1, 40, (50, 99)), changes(3, 30, (0, 200)), []]  # late ones, and one segment twice
    whole = []
    for k, part in enumerate(parts):
        log.append(spark.createDataFrame(part, SCHEMA))
        whole += part
        if k in (1, 3):
            log.compact()
            assert len(log.parts()) == 1
        replay = A.apply_status_changes(alerts, spark.createDataFrame(whole, SCHEMA))[0]
        now = A.apply_status_changes(alerts, log.latest())[0]
        assert sorted(map(str, now.collect())) == sorted(map(str, replay.collect()))
    assert len(log.parts()) == 2


def test_what_is_appended_during_a_compaction_stays(spark, tmp_path, monkeypatch):
    log, other = (L.StatusLog(spark, str(tmp_path / "log")) for _ in range(2))
    log.append(spark.createDataFrame([("a1", "OPEN", T0)], SCHEMA))
    real = log.versions.commit

    def late(entry, expected):
        monkeypatch.undo()
        other.append(spark.createDataFrame([("a1", "CLOSED", T0 + dt.timedelta(hours=1))], SCHEMA))
        return real(entry, expected)

    monkeypatch.setattr(log.versions, "commit", late)
    log.compact()
    assert len(log.parts()) == 2 and [tuple(r)[:2] for r in log.latest().collect()] == [("a1", "CLOSED")]
    log.compact()
    assert len(log.parts()) == 1 and log.latest().first().status == "CLOSED"
