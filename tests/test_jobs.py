"""The storage job end to end on sf0.001, and the file sources/sinks."""
import os
import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF001
from txwatch.plans import jobs, publish as P
from txwatch.plans.pipeline import Ledger
from txwatch.sources import files, testdata as TD


def test_run_pipeline(spark):
    root = tempfile.mkdtemp(prefix="txw-job-")
    raw = TD.ledger_bronze(spark, SF001)
    paths = jobs.run_pipeline(spark, raw, root, "run1", TD.DEFAULT_RUN_TS)
    lg = Ledger(spark, SF001, persist=False)
    silver = spark.read.parquet(paths["silver"])
    # same kept ids as the in-memory ledger (file order only reorders copies
    # of identical content, so the kept id set is the same)
    assert silver.count() == lg.silver.count()
    assert silver.select("transaction_id").distinct().count() == silver.count()
    assert spark.read.parquet(paths["gold"]).count() == silver.count()
    assert spark.read.parquet(paths["alerts"]).count() == lg.alerts.count()
    audit = spark.read.parquet(paths["audit"])
    assert audit.count() == 4 and audit.where(F.col("status") != "success").count() == 0
    # month folders are zero-padded text
    assert any(d.startswith("month=09") for d in os.listdir(f"{paths['bronze']}/year=2022"))


def test_csv_source_positional_header(spark):
    root = tempfile.mkdtemp(prefix="txw-csv-")
    header = "Timestamp,From Bank,Account,To Bank,Account,Amount Received,Receiving Currency," \
             "Amount Paid,Payment Currency,Payment Format,Is Laundering\n"
    with open(f"{root}/t.csv", "w") as fh:
        fh.write(header + "2022/09/01 00:20,10,8000EBD30,10,8000EBD30,3697.34,US Dollar,3697.34,"
                          "US Dollar,Reinvestment,0\n")
    df = files.read_bronze_csv(spark, f"{root}/t.csv", "2022-09-18T00:00:00")
    r = df.first()
    assert r.Account_sender == "8000EBD30" and r["Amount Paid"] == 3697.34 and r.source == "ibm_aml"


def test_read_layer_chunks(spark):
    root = tempfile.mkdtemp(prefix="txw-layer-")
    spark.range(10).repartition(3).write.parquet(f"{root}/x")
    df = files.read_layer(spark, f"{root}/x")
    assert df.select("chunk_id").distinct().count() == 3
    assert df.groupBy("chunk_id").agg(F.max("row_in_chunk").alias("m")).where("m < 0").count() == 0


def test_jdbc_options_partitioned():
    o = files.jdbc_options("jdbc:x", "t", partition_column="id", lower=0, upper=100, partitions=8)
    assert o["numPartitions"] == "8" and o["fetchsize"] == "50000"


def test_staged_publish_blocks_on_failed_gate(spark):
    import pytest
    from txwatch.operators import quality as Q
    root = tempfile.mkdtemp(prefix="txw-stage-")
    lg = Ledger(spark, SF001, persist=False)
    with pytest.raises(ValueError):
        P.publish_staged(lg.silver, f"{root}/stage", f"{root}/silver",
                         gate=lambda d: Q.gate_silver(d, min_rows=10 ** 9),
                         partition_cols=("source", "year", "month"))
    assert not os.path.exists(f"{root}/silver")


def test_feature_sink_dynamic_overwrite(spark):
    root = tempfile.mkdtemp(prefix="txw-feat-")
    df = spark.createDataFrame([("a", "night", 1, 1, 0.0)], "transaction_id string, time_bucket string, "
                               "rolling_7d_tx_count long, rolling_30d_tx_count long, amount_zscore double")
    P.write_features(df, f"{root}/f", "2022-09-01")
    P.write_features(df, f"{root}/f", "2022-09-02")
    P.write_features(df, f"{root}/f", "2022-09-02")
    assert spark.read.parquet(f"{root}/f").count() == 2


def test_cluster_conf_bounds():
    from txwatch.session import cluster_conf
    big = cluster_conf(100 * 2 ** 40, 8000)
    assert big["spark.sql.shuffle.partitions"] == "100000"
    small = cluster_conf(2 ** 30, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 128   # floor: 2 per core
    assert small["spark.sql.adaptive.enabled"] == "true"
