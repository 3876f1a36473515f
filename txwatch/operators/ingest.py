"""Bronze layer: provenance columns, dead-letter split, partition counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch import schemas as S
from txwatch.functions import columns as C


def add_provenance(df: DataFrame, run_ts: str, source: str = S.SOURCE_IBM) -> DataFrame:
    """``ingested_at`` (run time as ISO text, a parameter so reruns are stable),
    ``source`` and a null ``typology``."""
    return df.withColumns({
        "ingested_at": F.lit(run_ts),
        "source": F.lit(source),
        "typology": F.lit(None).cast("string"),
    })


def add_year_month(df: DataFrame, ts_text: str = "Timestamp") -> DataFrame:
    """Partition columns from the transaction time; month zero-padded text."""
    ts = C.parse_timestamp(ts_text)
    return df.withColumns({
        "year": F.year(ts).cast("string"),
        "month": F.lpad(F.month(ts).cast("string"), 2, "0"),
    })


def is_bad_row(amount: str = "Amount Paid", sender: str = "Account_sender",
               receiver: str = "Account_receiver", ts_text: str | None = "Timestamp") -> F.Column:
    """Dead-letter rule: ``dead_letter_reason`` names one."""
    return dead_letter_reason(amount, sender, receiver, ts_text).isNotNull()


def dead_letter_reason(amount: str = "Amount Paid", sender: str = "Account_sender",
                       receiver: str = "Account_receiver", ts_text: str | None = "Timestamp") -> F.Column:
    """Why a row cannot enter silver (null: it can): amount missing or
    negative, an account missing, or a time that cannot be read."""
    a = F.col(amount)
    reason = (F.when(a.isNull(), F.lit("missing_amount")).when(a < 0, F.lit("negative_amount"))
              .when(F.col(sender).isNull() | F.col(receiver).isNull(), F.lit("missing_account")))
    return reason if ts_text is None else reason.when(C.parse_timestamp(ts_text).isNull(), F.lit("bad_timestamp"))


def split_dead_letter(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, dead) from one flag column; both sides read the same plan."""
    ts = "Timestamp" if "Timestamp" in bronze.columns else None
    flagged = bronze.withColumn("_bad", is_bad_row(ts_text=ts))
    clean = flagged.where(~F.col("_bad")).drop("_bad")
    dead = flagged.where(F.col("_bad")).drop("_bad")
    return clean, dead


def partition_counts(bronze: DataFrame) -> DataFrame:
    """Rows per (year, month) partition of the bronze layer."""
    return (add_year_month(bronze).groupBy("year", "month")
            .agg(F.count(F.lit(1)).alias("row_count")))


def sample_rows(df: DataFrame, fraction: float, seed: int = 42, key: str | None = None) -> DataFrame:
    """Bernoulli sample. With ``key`` a row is kept when the leading 52 bits of
    the MD5 of seed and key fall under ``fraction`` (the same rows whatever the
    partitioning or row order, so reruns and retried tasks agree); without
    it, Spark's per-partition ``sample``. A fraction >= 1 keeps every row."""
    if fraction >= 1.0:
        return df
    if key is None:
        return df.sample(fraction=fraction, seed=seed)
    bits = 1 << 52
    digest = F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))
    bucket = F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
    return df.where(bucket < F.lit(int(fraction * bits)))
