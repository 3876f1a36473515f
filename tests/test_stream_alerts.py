"""Stream alerts equal the batch, and a batch or file that comes again changes nothing."""
import os

import pyarrow.parquet as pq

from tests.conftest import SF001
from txwatch.sources import testdata as TD
from txwatch.streaming import alerts as SA
from txwatch.streaming.streams import events_to_payments

RUN = "2022-09-18T00:00:00"


def rows(df):
    return sorted(tuple(r) for r in df.select(*SA.ALERT).collect())


def test_equals_batch_and_replays_change_nothing(spark, tmp_path):
    payments = TD.events_payments(spark, SF001)
    averages = SA.sender_averages(payments)
    batch = SA.unusual(events_to_payments(TD.read_table(spark, SF001, "events")).where("not _bad"), averages, RUN)
    tab = pq.read_table(f"{SF001}/events.parquet")
    third = tab.num_rows // 3
    # the middle file is sent twice
    for k, (a, n) in enumerate([(0, third), (third, third), (third, third), (2 * third, tab.num_rows)]):
        pq.write_table(tab.slice(a, n), tmp_path / f"events_{k}.parquet")
        os.utime(tmp_path / f"events_{k}.parquet", (1_700_000_000 + k,) * 2)
    got = SA.stream_alerts(spark, str(tmp_path), averages, RUN, max_files=1)
    assert rows(got) == rows(batch) and got.count() > 10
    # an attempt of a batch that ran before
    out = str(tmp_path / "alerts")
    SA.put(batch.limit(3), 0, out)
    SA.put(batch, 0, out)
    SA.put(batch, 1, out)
    SA.put(batch, 1, out)
    assert rows(SA.alerts(spark, out, batch.schema)) == rows(batch)
