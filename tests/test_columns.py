"""Scalar column functions against the edge rows of FIXTURES.md."""
import datetime as dt

from txwatch.functions import columns as C
from txwatch.functions import rules as R


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_mask_keeps_short_and_null(spark):
    got = one(spark, [("ACC001",), ("ab",), (None,)], "a string", C.mask_account("a"))
    assert got == ["****C001", "****ab", None]


def test_currency_code_passthrough(spark):
    got = one(spark, [("US Dollar",), ("Yen",), ("Dogecoin",), (None,)], "c string",
              C.currency_code("c"))
    assert got == ["USD", "JPY", "Dogecoin", None]


def test_risk_level_edges(spark):
    rows = [(0.95,), (0.75,), (0.50,), (0.10,), (0.90,), (0.70,), (0.40,), (0.39,), (0.0,), (None,)]
    got = one(spark, rows, "s double", C.risk_level("s"))
    assert got == ["CRITICAL", "HIGH", "MEDIUM", "LOW", "CRITICAL", "HIGH", "MEDIUM", "LOW", "LOW",
                   "UNKNOWN"]


def test_histogram_bins_include_one(spark):
    got = one(spark, [(0.0,), (0.05,), (0.95,), (1.0,), (0.1,)], "s double", C.histogram_bin("s"))
    assert got == [0, 0, 9, 9, 1]


def test_calendar(spark):
    ts = [(dt.datetime(2022, 9, 1, 0, 0),), (dt.datetime(2022, 9, 3, 23, 0),),
          (dt.datetime(2022, 9, 5, 7, 0),)]
    df = spark.createDataFrame(ts, "t timestamp_ntz")
    r = df.select(C.tx_day_of_week("t").alias("d"), C.tx_hour("t").alias("h"),
                  C.time_bucket("t").alias("b")).collect()
    assert [x.d for x in r] == [3, 5, 0]   # Monday = 0
    assert [x.h for x in r] == [0, 23, 7]
    assert [x.b for x in r] == ["night", "night", "morning"]


def test_cross_currency_null_counts_as_different(spark):
    rows = [("USD", "USD"), ("USD", "EUR"), (None, "USD"), (None, None)]
    got = one(spark, rows, "a string, b string", C.is_cross_currency("a", "b"))
    assert got == [0, 1, 1, 1]


def test_structuring_and_round_edges(spark):
    amounts = [8999.99, 9000.0, 9999.99, 10000.0, 999.5, 1000.5, 1001.5, 999.6, 0.0, -1000.0]
    df = spark.createDataFrame([(a,) for a in amounts], "amount double")
    r = df.select(R.is_structuring().alias("s"), R.is_round_amount().alias("r")).collect()
    assert [x.s for x in r] == [0, 1, 1, 0, 0, 0, 0, 0, 0, 0]
    # half-even rounding cast: 8999.99->9000, 9999.99->10000, 999.5->1000,
    # 1000.5->1000, 1001.5->1002, 999.6->1000; zero and negatives never count
    assert [x.r for x in r] == [1, 1, 1, 1, 1, 1, 0, 1, 0, 0]


def test_amount_log_clips_negative(spark):
    got = one(spark, [(-5.0,), (0.0,), (9.0,)], "a double", C.amount_log("a"))
    assert got[0] == 0.0 and got[1] == 0.0 and abs(got[2] - 2.302585092994046) < 1e-15


def test_transaction_id_is_stable_text(spark):
    df = spark.createDataFrame([("ibm_aml", "2022-09-01 00:00:00", "A", "B", 1.0e7, "ACH")],
                               "s string, t string, a string, b string, m double, f string")
    got = df.select(C.transaction_id("s", "t", "a", "b", "m", "f")).first()[0]
    import hashlib
    want = hashlib.md5(b"ibm_aml_2022-09-01 00:00:00_A_B_10000000.00_ACH").hexdigest()
    assert got == want


def test_parse_timestamp_bad_text_is_null(spark):
    got = one(spark, [("2022-09-01 10:20:30",), ("2022/09/01 10:20",), ("junk",)], "t string",
              C.parse_timestamp("t"))
    assert got == [dt.datetime(2022, 9, 1, 10, 20, 30), dt.datetime(2022, 9, 1, 10, 20), None]


def test_pct_zero_base(spark):
    df = spark.createDataFrame([(1, 0), (1, 3)], "a long, b long")
    assert [r[0] for r in df.select(C.pct("a", "b")).collect()] == [0.0, 33.3333]
