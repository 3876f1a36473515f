"""Adapters from the driver's TPC-H-like tables to payment records.

``ledger_bronze`` turns ``lineitem ⋈ orders ⋈ customer ⋈ supplier`` into raw
(bronze) payment rows over 17 days from 2022-09-01, with integer arithmetic
only so that any SQL engine derives exactly the same rows. Copies of some
rows are added in a later chunk (inter-chunk duplicates) and in the same
chunk (intra-chunk duplicates), and some rows get a missing or negative
amount or a missing account, so dedup and the dead-letter route see work.
``events_payments`` maps the ``events`` table to the same silver columns
(sender = user, type = event type, amount = value) for long windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwatch import schemas as S
from txwatch.functions import columns as C

LEDGER_START = "2022-09-01 00:00:00"
DEFAULT_RUN_TS = "2022-09-18T00:00:00"
# Fixed values of the adapter: payment format by l_linenumber % 7 and the
# currency names in the order of CURRENCY_CODES (index = nationkey % 15).
FORMAT_BY_LINE = ("Reinvestment", "ACH", "Bitcoin", "Cash", "Cheque", "Credit Card", "Wire")
CURRENCY_NAMES = tuple(S.CURRENCY_CODES.keys())
HOT_SENDER_EVERY = 10      # o_custkey % 10 = 0 -> one shared (hot) sender account
OUTLIER_EVERY = 199        # l_partkey % 199 = 0 -> amount x 20
INTER_COPY_EVERY = 50      # l_orderkey % 50 = 0 -> copy in the next chunk
INTRA_COPY_EVERY = 75      # l_orderkey % 75 = 0 -> copy in the same chunk
BAD_AMOUNT_EVERY = 97      # l_orderkey % 97 = 0 -> null (odd line) / negative (even line) amount
NULL_ACCOUNT_EVERY = 89    # l_orderkey % 89 = 0 and line 3 -> null receiver account
JUNK_TIME_EVERY = 83       # l_orderkey % 83 = 0 and line 2 -> a time that cannot be read
CHUNKS = 4

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values, idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx.cast("int") + 1)


def ledger_bronze(spark: SparkSession, sf_dir: str, run_ts: str = DEFAULT_RUN_TS,
                  with_copies: bool = True, with_bad_rows: bool = True) -> DataFrame:
    """Bronze payment rows plus ``chunk_id`` and the ordinal columns
    ``src_orderkey, src_linenumber, src_partkey, src_suppkey, copy_no``."""
    label = ((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.09)).cast("int")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", label.alias("_label"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # the narrow tables meet first, so that the lines move once
    payers = orders.join(cust, F.col("o_custkey") == cust.c_custkey)
    j = (li.join(payers, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(supp, F.col("l_suppkey") == supp.s_suppkey))

    ok, pk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    secs = (ok % 17) * 86400 + (ok * 7919 + pk * 131 + ln * 17) % 86400
    ts = F.timestamp_add("SECOND", secs, F.lit(LEDGER_START).cast(T.TimestampNTZType()))
    sender = F.lpad(F.when(F.col("o_custkey") % HOT_SENDER_EVERY == 0, F.lit(0))
                    .otherwise(F.col("o_custkey")).cast("string"), 9, "0")
    receiver = F.lpad(F.col("l_suppkey").cast("string"), 9, "0")
    scale = F.when(pk % OUTLIER_EVERY == 0, F.lit(20)).otherwise(F.lit(1))
    amount = (F.col("l_extendedprice").cast("decimal(18,2)") * scale).cast("double")
    if with_bad_rows:
        amount = (F.when((ok % BAD_AMOUNT_EVERY == 0) & (ln % 2 == 1), F.lit(None).cast("double"))
                  .when(ok % BAD_AMOUNT_EVERY == 0, -amount)
                  .otherwise(amount))
        receiver = F.when((ok % NULL_ACCOUNT_EVERY == 0) & (ln == 3),
                          F.lit(None).cast("string")).otherwise(receiver)
    stamp = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    if with_bad_rows:
        stamp = F.when((ok % JUNK_TIME_EVERY == 0) & (ln == 2), F.lit("not a time")).otherwise(stamp)

    base = j.select(
        stamp.alias("Timestamp"),
        F.col("c_nationkey").cast("string").alias("From Bank"),
        sender.alias("Account_sender"),
        F.col("s_nationkey").cast("string").alias("To Bank"),
        receiver.alias("Account_receiver"),
        amount.alias("Amount Received"),
        _pick(CURRENCY_NAMES, F.col("s_nationkey") % 15).alias("Receiving Currency"),
        amount.alias("Amount Paid"),
        _pick(CURRENCY_NAMES, F.col("c_nationkey") % 15).alias("Payment Currency"),
        _pick(FORMAT_BY_LINE, ln % 7).alias("Payment Format"),
        F.col("_label").alias("Is Laundering"),
        F.lit(run_ts).alias("ingested_at"),
        F.lit(S.SOURCE_IBM).alias("source"),
        (ok % CHUNKS).cast("int").alias("chunk_id"),
        ok.alias("src_orderkey"), ln.alias("src_linenumber"),
        pk.alias("src_partkey"), F.col("l_suppkey").alias("src_suppkey"),
    )
    if not with_copies:
        return base.withColumn("copy_no", F.lit(0))
    # One pass, no re-scan: each row explodes into itself plus its copies
    # (sequence + explode stays inside whole-stage codegen).
    okey = F.col("src_orderkey")
    inter = (okey % INTER_COPY_EVERY == 0).cast("int")
    intra = (okey % INTRA_COPY_EVERY == 0).cast("int")
    out = base.withColumn("_i", F.explode(F.sequence(F.lit(0), inter + intra)))
    copy_no = (F.when(F.col("_i") == 0, F.lit(0))
               .when((F.col("_i") == 1) & (inter == 1), F.lit(1)).otherwise(F.lit(2)))
    out = out.withColumn("copy_no", copy_no)
    return (out.withColumn("chunk_id", F.col("chunk_id") + (F.col("copy_no") == 1).cast("int"))
            .drop("_i"))


# A column of ``ledger_bronze`` that is the same as another.
SAME = {"Amount Received": "Amount Paid"}
ORDINAL_COLUMNS = ("src_orderkey", "src_linenumber", "src_partkey", "src_suppkey", "copy_no")
# digits of each ordinal column after the first, for a packed sortable key
ORDINAL_DIGITS = (("src_orderkey", 0), ("src_linenumber", 1), ("src_partkey", 10),
                  ("src_suppkey", 10), ("copy_no", 1))


def events_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as silver-like payments: sender = user, type = event type."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.md5(F.concat(F.lit("evt_"), F.col("event_id").cast("string"))).alias("transaction_id"),
        F.col("ts").alias("timestamp"),
        C.mask_account(F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("sender_account_masked"),
        F.col("event_type").alias("payment_type"),
        F.col("value").alias("amount"),
    )


def saml_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second, typology-carrying source in its own column layout, derived
    from ``events``: sender = user, receiver = the ``k`` of props, type =
    event type, typology set on error events."""
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object(F.col("props"), "$.k")
    return ev.select(
        F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.lit("EVT").alias("from_bank"),
        F.lpad(F.col("user_id").cast("string"), 9, "0").alias("from_account"),
        F.lit("EVT").alias("to_bank"),
        F.lpad(F.coalesce(k, F.lit("0")), 9, "0").alias("to_account"),
        F.col("value").alias("amount"),
        F.lit("US Dollar").alias("currency"),
        F.col("event_type").alias("payment_type"),
        (F.col("event_type") == "error").cast("int").alias("is_laundering"),
        F.when(F.col("event_type") == "error", F.lit("error_burst")).alias("typology"),
    )
