"""Gates return one row per rule and flag violations."""
import datetime as dt

from txwatch.operators import quality as Q


def test_gate_silver(spark):
    rows = [("a", -1.0, 0), ("a", 2.0, 1), (None, 3.0, 2), ("b", 4.0, 0)]
    df = spark.createDataFrame(rows, "transaction_id string, amount double, is_laundering long")
    got = {r.rule: (r.violations, r.passed) for r in Q.gate_silver(df, min_rows=4).collect()}
    assert got == {"null_transaction_id": (1, False), "negative_amount": (1, False),
                   "duplicate_transaction_id": (1, False), "invalid_label": (1, False),
                   "min_rows": (0, True)}


def test_rules_silver_mask(spark):
    rows = [("a", "****AB12", "****0001", 1.0, 0), ("b", "***AB12", "****0001", 0.0, 0)]
    df = spark.createDataFrame(rows, "transaction_id string, sender_account_masked string, "
                                     "receiver_account_masked string, amount double, is_laundering long")
    got = {r.rule: r.violations for r in Q.rules_silver(df).collect()}
    assert got == {"mask_format": 1, "amount_positive": 1, "label_rate_in_range": 0,
                   "unique_transaction_id": 0}


def test_contract_future_timestamp(spark):
    from txwatch import schemas as S
    row = {c: "x" for c in S.UNIFIED_COLUMNS}
    row.update(timestamp=dt.datetime(2030, 1, 1), amount=1.0, is_laundering=0,
               payment_currency="USD", receiving_currency="EUR")
    df = spark.createDataFrame([row]).select(*S.UNIFIED_COLUMNS)
    got = {r.rule: r.violations for r in Q.contract_rules(df, "2022-09-18T00:00:00").collect()}
    assert got["timestamp_not_future"] == 1 and got["valid_currency_codes"] == 0


def test_silver_gate_compares_only_ids_that_may_come_twice(spark):
    rows = [("a", 1.0, 0), ("a", -1.0, 1), ("a", 2.0, 1), ("b", 1.0, None), ("b", 1.0, 2), (None, None, 0), (None, 3.0, 1)] + [(f"u{i}", 1.0, 0) for i in range(500)]
    df = spark.createDataFrame(rows, "transaction_id string, amount double, is_laundering int")
    report = Q.gate_silver(df, 508)
    assert {r.rule: r.violations for r in report.collect()} == {
        "null_transaction_id": 2, "negative_amount": 1, "duplicate_transaction_id": 2, "invalid_label": 2, "min_rows": 1}
    assert all(r.violations == 0 for r in Q.gate_silver(df.limit(0), 0).collect())
    by_id = report._jdf.queryExecution().toString().split("== Physical Plan ==")[0]
    assert "_again" in by_id  # the text moves only of marked rows
