"""Rule score exactness and the ordered typology arms."""

from txwatch.functions import rules as R
from txwatch.operators import features as FE

GOLD_SCHEMA = ("amount double, payment_type string, is_cross_currency long, "
               "sender_tx_count_1h long, amount_vs_sender_avg double")


def score_rows(spark, rows):
    df = spark.createDataFrame(rows, GOLD_SCHEMA)
    return FE.rule_features(df).withColumn("typology", R.typology())


def test_rule_score_is_exact_and_capped(spark):
    rows = [(9500.0, "ACH", 1, 1, 1.0),        # .30+.20+.25+.15 = .90
            (9000.0, "ACH", 1, 1, 1.0),        # + round .10 -> capped at 1.0
            (100.0, "Wire", 0, 1, 1.0),        # 0
            (100.0, "Unknown", 0, 1, 1.0),     # default risk .050*.30 = .015
            (100.0, "Cash", 1, 1, 1.0)]        # .058*.30 + .20 = .2174
    got = [r.rule_score for r in score_rows(spark, rows).collect()]
    assert got == [0.9, 1.0, 0.0, 0.015, 0.2174]


def test_typology_order(spark):
    rows = [(9500.0, "ACH", 1, 6, 20.0),        # structuring + >5 -> structuring_rapid
            (9500.0, "ACH", 1, 5, 20.0),        # structuring
            (100.0, "Bitcoin", 1, 50, 20.0),    # high risk + cross before rapid
            (100.0, "Cash", 0, 11, 20.0),       # rapid_movement
            (100.0, "Cash", 0, 1, 10.5),        # unusual_amount
            (60000.0, "Cash", 0, 1, 1.0),       # large_round_amount
            (60000.5, "Cash", 0, 1, 1.0)]       # half-even: 60000 -> round too
    got = [r.typology for r in score_rows(spark, rows).collect()]
    assert got == ["structuring_rapid", "structuring", "cross_currency_high_risk",
                   "rapid_movement", "unusual_amount", "large_round_amount", "large_round_amount"]


def test_sender_key_keeps_colliding_accounts_apart(spark):
    from txwatch.operators import standardize as ST
    rows = [("2022-09-01 00:00:00", "1", "AAA1234", "2", "B0001", 100.0, "US Dollar", 100.0,
             "US Dollar", "ACH", 0, "t", "ibm_aml"),
            ("2022-09-01 00:10:00", "1", "ZZZ1234", "2", "B0002", 100.0, "US Dollar", 100.0,
             "US Dollar", "ACH", 0, "t", "ibm_aml")]
    cols = ["Timestamp", "From Bank", "Account_sender", "To Bank", "Account_receiver",
            "Amount Received", "Receiving Currency", "Amount Paid", "Payment Currency",
            "Payment Format", "Is Laundering", "ingested_at", "source"]
    silver = ST.standardize(spark.createDataFrame(rows, cols), with_sender_key=True)
    masked = FE.gold_features(silver, block_seconds=3600)
    keyed = FE.sender_velocity(silver, sender="sender_key", block_seconds=3600)
    assert sorted(r.sender_tx_count_1h for r in masked.collect()) == [1, 2]   # "****1234" merges
    assert sorted(r.sender_tx_count_1h for r in keyed.collect()) == [1, 1]
