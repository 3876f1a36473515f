"""Alerts from a stream: events meet a table of sender averages, unusual ones become alerts.

Each micro-batch writes its alerts into a folder named by its number, in place of
what an earlier attempt of the same batch left there, and readers take each alert
once (the alert id follows from the transaction). So a batch that runs twice, or
a file that is sent twice, changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwatch.session import scratch_path
from txwatch.streaming.streams import events_to_payments, read_event_stream

RATIO = 1.9
ALERT = ["alert_id", "transaction_id", "sender_account_masked", "timestamp", "amount", "amount_vs_sender_avg"]


def sender_averages(payments: DataFrame) -> DataFrame:
    """``sender, average`` from a batch table; money is added up in decimal."""
    total = F.sum(F.col("amount").cast("decimal(24,6)")).cast("double")
    return payments.groupBy(F.col("sender_account_masked").alias("sender")).agg((total / F.count("amount").cast("double")).alias("average"))


def unusual(payments: DataFrame, averages: DataFrame, run_ts: str, ratio: float = RATIO) -> DataFrame:
    """Payments of ``ratio`` times their sender's average or more (batch or stream);
    senders without an average have none."""
    over = F.col("amount") / F.greatest(F.col("average"), F.lit(0.01))
    return (payments.join(averages, F.col("sender_account_masked") == F.col("sender"))
            .withColumn("amount_vs_sender_avg", over).where(F.col("amount_vs_sender_avg") >= ratio)
            .withColumn("alert_id", F.md5(F.concat("transaction_id", F.lit(run_ts)))).select(*ALERT))


def put(batch: DataFrame, number: int, path: str) -> None:
    """The alerts of one micro-batch, in place of an earlier attempt's."""
    batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batch={number}")


def alerts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Each alert once, from the first batch that has it."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    first = F.min_by(F.struct(*[c for c in schema.fieldNames() if c != "alert_id"]), "batch").alias("a")
    return rows.groupBy("alert_id").agg(first).select("alert_id", "a.*")


def stream_alerts(spark: SparkSession, sf_dir: str, averages: DataFrame, run_ts: str, ratio: float = RATIO,
                  max_files: int | None = None) -> DataFrame:
    """All alerts of the events that are there, as a stream of micro-batches."""
    out = scratch_path(spark, "stream-alerts")
    rows = events_to_payments(read_event_stream(spark, sf_dir, max_files)).where("not _bad").drop("_bad")
    found = unusual(rows, averages, run_ts, ratio)
    q = (found.writeStream.foreachBatch(lambda batch, number: put(batch, number, f"{out}/alerts"))
         .option("checkpointLocation", f"{out}/_chk").trigger(availableNow=True).start())
    q.awaitTermination()
    return alerts(spark, f"{out}/alerts", found.schema)
