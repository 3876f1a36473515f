"""The contract decides how sources are read and what the gate asks."""
import json

import pytest
from pyspark.sql import functions as F

from txwatch import schemas as S
from txwatch.functions import columns as C
from txwatch.functions import rules as R
from txwatch.operators import contract as K
from txwatch.operators import standardize as ST


def second(spark, rows):
    return spark.createDataFrame(rows, S.SAML_CSV_SCHEMA)


GOOD = ("2024-01-01 10:00:00", "b1", "a1", "b2", "a2", 12.5, "Euro", "ACH", 0, None)


def test_reads_and_maps_the_second_source(spark, tmp_path):
    lines = ["timestamp,from_bank,from_account,to_bank,to_account,amount,currency,payment_type,is_laundering,typology",
             "2024-01-01 10:00:00,b1,a1,b2,a2,12.5,Euro,ACH,0,", "2024-01-01 10:00:00,b1,a1,b2,a2", "x,b1,a1,b2,a2,9,Euro,ACH,1,fan_in",
             "2024-01-01 10:00:00,b1,a1,b2,a2,much,Euro,ACH,0,", "2024-01-01 10:00:00,b1,a1,b2,a2,1,Euro,ACH,0,t,more"]
    (tmp_path / "second.csv").write_text("\n".join(lines) + "\n")
    contract = K.Contract(K.default_contract())
    read = contract.read(spark, str(tmp_path / "second.csv"), S.SOURCE_SAML)
    read.write.parquet(str(tmp_path / "read"))
    rows, broken = K.fit_lines(spark.read.parquet(str(tmp_path / "read")))
    assert sorted(r.line for r in broken.collect()) == sorted([lines[2], lines[4], lines[5]])
    assert all(r.file.endswith("second.csv") for r in broken.collect()) and rows.count() + broken.count() == len(lines) - 1
    got = contract.unified(rows, S.SOURCE_SAML)
    want = ST.to_unified(second(spark, [GOOD, ("x", "b1", "a1", "b2", "a2", 9.0, "Euro", "ACH", 1, "fan_in")]), S.SOURCE_SAML)
    assert got.columns == list(S.UNIFIED_COLUMNS)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    report = {r.rule: r.violations for r in contract.gate(got, "2024-02-01T00:00:00").collect()}
    assert report["timestamp_required"] == 1 and report["amount_required"] == 0 and report["transaction_id_unique"] == 0


def test_changing_the_contract_changes_the_gate(spark, tmp_path):
    spec = K.default_contract()
    unified = K.Contract(spec).unified(second(spark, [GOOD, GOOD, ("2030-01-01 10:00:00", "b1", "a1", "b2", "a2", -1.0, "Doubloon", "ACH", 2, None)]), S.SOURCE_SAML)

    def violations(spec, run_ts="2024-02-01T00:00:00"):
        return {r.rule: r.violations for r in K.Contract(spec).gate(unified, run_ts).collect() if r.violations}

    base = violations(spec)
    assert base == {"amount_at_least_0": 1, "is_laundering_one_of": 1, "valid_currency_codes": 1, "timestamp_not_future": 1, "transaction_id_unique": 1}
    file = tmp_path / "contract.json"
    spec["unified_schema"]["columns"]["amount"] |= {"min": 13, "max": 20}
    spec["unified_schema"]["columns"]["typology"]["required"] = True
    spec["unified_schema"]["columns"]["is_laundering"]["values"] = [0, 1, 2]
    spec["unified_schema"]["columns"]["transaction_id"]["unique"] = False
    spec["quality_rules"] = []
    file.write_text(json.dumps(spec))
    assert violations(K.load(str(file))) == {"amount_at_least_13": 3, "typology_required": 3}
    spec["sources"]["third"] = {"columns": {"timestamp": {"type": "datetime"}, "from_account": {"type": "string"}, "amount": {"type": "float"}}}
    third = K.Contract(spec)
    assert [f.name for f in third.schema("third").fields] == ["timestamp", "from_account", "amount"]
    row = third.unified(spark.createDataFrame([("2024-01-01 10:00", "a", 1.0)], third.schema("third")), "third").first()
    assert row.sender_account == "a" and row.receiver_account is None and row.source == "third"
    with pytest.raises(ValueError):
        third.schema("fourth")


def test_yaml_contract(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text("sources:\n  one:\n    columns:\n      amount: {type: float, required: true, min: 0}\n")
    assert K.load(str(tmp_path / "c.yaml"))["sources"]["one"]["columns"]["amount"] == {"type": "float", "required": True, "min": 0}


def test_times_are_read_strictly(spark):
    texts = ["2022/09/01 00:20", "2022-09-01 00:20:05", "2022-09-01T00:20:05.25", "2022", "2022-09", "2022-09-01", "2022-9-1 0:20", "2022-13-01 00:20",
             "2022-09-01 00:20 x", "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", C.parse_timestamp("t").alias("t")).collect()
    assert [r.i for r in rows if r.t is not None] == [0, 1, 2]


def test_ratio_needs_an_amount_and_an_average(spark):
    df = spark.createDataFrame([(1, 10.0, 5.0), (2, 10.0, None), (3, None, 5.0), (4, 10.0, 0.0)], "i int, amount double, sender_avg_amount double")
    assert {r.i: r.v for r in df.select("i", R.amount_vs_sender_avg().alias("v")).collect()} == {1: 2.0, 2: None, 3: None, 4: 1000.0}
    assert df.agg(F.count("amount")).first()[0] == 3


def test_a_folder_of_files_lacks_a_column_if_one_file_does(spark, tmp_path):
    from txwatch import schemas as S
    from txwatch.operators import quality as Q
    rows = spark.range(8).select(*[F.lit("x").alias(c) for c in S.BRONZE_REQUIRED]).repartition(3)
    rows.write.parquet(str(tmp_path / "chunk=0"))
    rows.write.parquet(str(tmp_path / "chunk=1"))
    rows.drop("To Bank").limit(1).write.mode("append").parquet(str(tmp_path / "chunk=1"))
    got = {r.rule: r.violations for r in Q.gate_bronze_files(spark, str(tmp_path), min_files=3, by_folder=True).collect()}
    assert got["min_files"] == 1 and got["files_without_to_bank"] == 1 and got["files_without_timestamp"] == 0
    assert {r.rule: r.violations for r in Q.gate_bronze_files(spark, str(tmp_path), min_files=3).collect()}["min_files"] == 0
