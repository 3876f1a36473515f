"""Property-based check: block-split trailing sums equal brute force for
random keys, timestamps (with ties), amounts and block widths."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.test_windows import brute
from txwatch.operators.sliding import sliding_sums

T0 = dt.datetime(2022, 9, 1)
ROW = st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]),
                st.integers(min_value=0, max_value=4 * 3600),
                st.integers(min_value=1, max_value=999))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, min_size=1, max_size=60), block=st.sampled_from([1, 300, 900, 1800, 3600]))
def test_sliding_sums_property(spark, rows, block):
    data = [(f"id{i}", k, T0 + dt.timedelta(seconds=s), float(a)) for i, (k, s, a) in enumerate(rows)]
    df = spark.createDataFrame(data, "id string, k string, ts timestamp_ntz, amount double")
    got = sliding_sums(df, ["k"], "ts", [("n", 3600, None), ("s", 3600, "amount")], block)
    assert {r.id: (r.n, r.s) for r in got.collect()} == brute(data, 3600)
