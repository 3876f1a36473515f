"""Sinks: partitioned layer writes, staged publish, audit rows, exports.

All writes run on executors; folders are partitioned by the data's own
year/month (never a fixed path). Staged publishes write to a staging folder,
run the gate, then move the folder into place.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txwatch import schemas as S
from txwatch.operators import ingest as I
from txwatch.operators.quality import raise_if_failed


def write_bronze(bronze: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Year/month partitioned Parquet (month zero-padded text)."""
    write_layer(I.add_year_month(bronze), path, ("year", "month"), mode)


def write_layer(df: DataFrame, path: str, partition_cols=("source", "year", "month"),
                mode: str = "overwrite", max_records: int = 5_000_000, few: int = 0, codec: str | None = None) -> None:
    """Partitioned Parquet. The rebalance hint gathers each output partition in
    few tasks, and AQE splits a partition that is too large for one (a month
    that holds most rows); ``max_records`` bounds single files. With at most
    ``few`` output partitions (counted first, for rows that are written already)
    nothing moves: each task writes its rows of each of them."""
    parts = [c for c in partition_cols]
    with_parts = df
    if "year" in parts and "year" not in df.columns:
        with_parts = with_parts.withColumns({
            "year": F.year("timestamp").cast("string"),
            "month": F.lpad(F.month("timestamp").cast("string"), 2, "0")})
    if not few or with_parts.select(*parts).distinct().limit(few + 1).count() > few:
        with_parts = with_parts.hint("rebalance", *parts)
    with_parts.write.mode(mode).option("maxRecordsPerFile", max_records).partitionBy(*parts).parquet(path, compression=codec)


def write_features(df: DataFrame, root: str, run_date: str) -> None:
    """Overwrite only this ``run_date`` partition (dynamic overwrite)."""
    (df.select("transaction_id", "time_bucket", "rolling_7d_tx_count",
               "rolling_30d_tx_count", "amount_zscore")
     .withColumn("run_date", F.lit(run_date))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date").parquet(root))


def write_splits(ds: DataFrame, root: str) -> None:
    ds.drop("transaction_id").write.mode("overwrite").partitionBy("split").parquet(root)


def write_scores(scores: DataFrame, path: str) -> None:
    scores.write.mode("overwrite").parquet(path)


def export_alerts_csv(export: DataFrame, path: str) -> None:
    export.write.mode("overwrite").option("header", True).csv(path)


def _move(spark: SparkSession, src: str, dst: str) -> None:
    """Put ``src`` in the place of ``dst``. The old layer steps aside first and
    goes last, so a crash at any point leaves one of the two, and the next
    call ends the move. Doing it again when only ``dst`` is there is no error."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src_p, dst_p = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    fs = src_p.getFileSystem(conf)
    aside = jvm.org.apache.hadoop.fs.Path(dst.rstrip("/") + "._old")
    if not fs.exists(src_p):
        if not fs.exists(dst_p) and fs.exists(aside):
            fs.rename(aside, dst_p)
        if not fs.exists(dst_p):
            raise FileNotFoundError(f"neither {src} nor {dst} is there")
        return
    parent = dst_p.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    if fs.exists(dst_p):
        if fs.exists(aside):
            fs.delete(aside, True)
        if not fs.rename(dst_p, aside):
            raise OSError(f"could not move {dst} aside")
    if not fs.rename(src_p, dst_p):
        raise OSError(f"could not move {src} to {dst}")
    if fs.exists(aside):
        fs.delete(aside, True)


def publish_staged(df: DataFrame, staging: str, target: str,
                   gate: Callable[[DataFrame], DataFrame] | None = None,
                   partition_cols=("year", "month")) -> DataFrame | None:
    """Write to ``staging``, run ``gate`` on the written data (raises on a
    failed rule), then move staging onto ``target``. Returns the gate report."""
    spark = df.sparkSession
    write_layer(df, staging, partition_cols)
    report = None
    if gate is not None:
        report = gate(spark.read.parquet(staging))
        raise_if_failed(report)
    _move(spark, staging, target)
    return report


def observed_write(df: DataFrame, path: str, label_col: str | None = "is_laundering",
                   partition_cols=()) -> dict:
    """Write and count in the same pass (``observe``); returns the metrics."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if label_col and label_col in df.columns:
        aggs.append(F.sum(F.col(label_col).cast("bigint")).alias("positives"))
    obs = Observation("write")
    w = df.observe(obs, *aggs).write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
    return obs.get


def audit_row(spark: SparkSession, dag_id: str, run_id: str, task_id: str, layer: str,
              status: str, rows: int, dead: int, started: float, positives: int | None = None,
              error: str | None = None) -> DataFrame:
    rate = (positives / rows * 100) if positives is not None and rows else None
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    return spark.createDataFrame(
        [(dag_id, run_id, task_id, layer, status, int(rows), int(dead),
          float(time.time() - started), rate, error, now)], S.AUDIT_SCHEMA)


def append_audit(audit: DataFrame, path: str) -> None:
    audit.write.mode("append").parquet(path)
