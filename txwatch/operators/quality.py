"""Validation gates and contract rules.

Every gate computes all of its rules in one aggregate (one scan; a
duplicate-id rule adds one grouped shuffle) and returns one row per rule:
``(rule, violations, passed)``. Raising is left to the caller
(``raise_if_failed``) so the audit row can be written first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwatch import schemas as S
from txwatch.functions import columns as C
from txwatch.operators.standardize import AGAIN, with_again

MASK_PATTERN = r"^\*{4}[A-Z0-9]{4}$"


def _rules(agg_row: DataFrame, rules: list[tuple[str, Column, Column | None]]) -> DataFrame:
    """rules: (name, violations column over agg_row, passed column or None
    meaning violations == 0)."""
    structs = []
    for name, viol, passed in rules:
        v = F.coalesce(viol.cast("bigint"), F.lit(0))
        p = (v == 0) if passed is None else F.coalesce(passed, F.lit(False))
        structs.append(F.struct(F.lit(name).alias("rule"), v.alias("violations"), p.alias("passed")))
    return agg_row.select(F.inline(F.array(*structs)))


def raise_if_failed(report: DataFrame) -> None:
    failed = report.where(~F.col("passed")).select("rule", "violations").collect()
    if failed:
        raise ValueError("quality gate failed: " + ", ".join(f"{r.rule}={r.violations}" for r in failed))


def _per_id(df: DataFrame, id_col: str, extra: dict[str, Column]) -> DataFrame:
    """Group by id once; carry per-id sums of the row-level rule counts."""
    aggs = [F.count(F.lit(1)).alias("_copies")] + [F.count_if(c).alias(k) for k, c in extra.items()]
    return df.groupBy(id_col).agg(*aggs)


def gate_silver(silver: DataFrame, min_rows: int = 6_000_000) -> DataFrame:
    a = silver.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("transaction_id").isNull()).alias("null_id"),
        F.count_if(F.col("amount") < 0).alias("neg"),
        F.count_if(~F.col("is_laundering").isin(0, 1) | F.col("is_laundering").isNull()).alias("badlabel"))
    # the ids' hashes move, and of the ids only those that may come twice
    ids = with_again(silver.select("transaction_id").where(F.col("transaction_id").isNotNull()))
    twice = ids.where(F.col(AGAIN)).groupBy("transaction_id").count().where(F.col("count") > 1)
    a = a.select("*", twice.agg(F.count(F.lit(1))).scalar().alias("dup"))
    return _rules(a, [
        ("null_transaction_id", F.col("null_id"), None),
        ("negative_amount", F.col("neg"), None),
        ("duplicate_transaction_id", F.col("dup"), None),
        ("invalid_label", F.col("badlabel"), None),
        ("min_rows", F.when(F.col("total") < min_rows, 1).otherwise(0), None),
    ])


def gate_gold(gold: DataFrame, min_rows: int = 6_000_000) -> DataFrame:
    s = F.col("rule_score")
    a = gold.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("transaction_id").isNull()).alias("null_id"),
        F.count_if(s.isNull()).alias("null_score"),
        F.count_if((s < 0) | (s > 1)).alias("bad_score"),
        F.count_if(F.col("sender_tx_count_1h").isNull()).alias("null_1h"),
        F.count_if(F.col("amount_vs_sender_avg").isNull()).alias("null_ratio"))
    return _rules(a, [
        ("null_transaction_id", F.col("null_id"), None),
        ("null_rule_score", F.col("null_score"), None),
        ("rule_score_out_of_range", F.col("bad_score"), None),
        ("null_sender_tx_count_1h", F.col("null_1h"), None),
        ("null_amount_vs_sender_avg", F.col("null_ratio"), None),
        ("min_rows", F.when(F.col("total") < min_rows, 1).otherwise(0), None),
    ])


def gold_profile(gold: DataFrame) -> DataFrame:
    return gold.agg(
        C.round_half_up(F.avg("rule_score"), 6).alias("avg_rule_score"),
        F.max("rule_score").alias("max_rule_score"),
        F.min("rule_score").alias("min_rule_score"),
        C.round_half_up(F.avg("sender_tx_count_1h"), 6).alias("avg_tx_1h"),
        F.max("sender_tx_count_1h").alias("max_tx_1h"),
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("is_laundering") == 1).alias("laundering_rows"))


def silver_profile(df: DataFrame) -> DataFrame:
    """Profile of standardised rows before dedup: nulls, negatives,
    duplicated rows (count − distinct), laundering rate, validity."""
    p = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("transaction_id").isNull()).alias("null_transaction_id"),
        F.count_if(F.col("amount").isNull()).alias("null_amount"),
        F.count_if(F.col("amount") < 0).alias("negative_amount"),
        (F.count(F.lit(1)) - F.count_distinct("transaction_id")
         - F.when(F.count_if(F.col("transaction_id").isNull()) > 0, 1).otherwise(0))
        .alias("duplicate_transaction_id"),
        C.round_half_up(F.avg("is_laundering") * 100, 4).alias("laundering_rate_pct"))
    return p.withColumn("is_valid", (F.col("null_transaction_id") == 0) & (F.col("null_amount") == 0)
                        & (F.col("negative_amount") == 0))


def rules_bronze(bronze: DataFrame) -> DataFrame:
    a = bronze.agg(
        F.count_if((F.col("Amount Paid") < 0) | (F.col("Amount Received") < 0)).alias("neg"),
        F.count_if(~F.col("Is Laundering").isin(0, 1) | F.col("Is Laundering").isNull()).alias("lab"),
        F.count_if(C.parse_timestamp("Timestamp").isNull()).alias("ts"),
        F.count_if(F.col("From Bank").isNull() | F.col("To Bank").isNull()).alias("bank"),
        F.count_if(~F.col("Payment Format").isin(*S.PAYMENT_FORMATS)
                   | F.col("Payment Format").isNull()).alias("fmt"))
    return _rules(a, [
        ("amounts_non_negative", F.col("neg"), None),
        ("label_binary", F.col("lab"), None),
        ("timestamp_parseable", F.col("ts"), None),
        ("bank_not_null", F.col("bank"), None),
        ("payment_format_valid", F.col("fmt"), None),
    ])


def rules_silver(silver: DataFrame, max_label_rate: float = 0.10) -> DataFrame:
    ids = _per_id(silver, "transaction_id", {
        "_mask": ~F.col("sender_account_masked").rlike(MASK_PATTERN)
        | ~F.col("receiver_account_masked").rlike(MASK_PATTERN),
        "_amt": ~(F.col("amount") > 0) | F.col("amount").isNull(),
        "_pos": F.col("is_laundering") == 1,
    })
    a = ids.agg(F.sum("_copies").alias("n"), F.sum("_mask").alias("mask"), F.sum("_amt").alias("amt"),
                F.sum("_pos").alias("pos"),
                F.count_if(F.col("_copies") > 1).alias("dup"))
    rate = F.try_divide(F.col("pos").cast("double"), F.col("n").cast("double"))
    return _rules(a, [
        ("mask_format", F.col("mask"), None),
        ("amount_positive", F.col("amt"), None),
        ("label_rate_in_range", F.when((rate >= 0) & (rate <= max_label_rate), 0).otherwise(1), None),
        ("unique_transaction_id", F.col("dup"), None),
    ])


GOLD_FLAGS = ("is_weekend", "is_cross_currency", "is_high_risk_type", "is_structuring",
              "is_round_amount", "is_laundering")


def _bad_number(c: str) -> Column:
    x = F.col(c).cast("double")
    return x.isNull() | F.isnan(x) | (x == float("inf")) | (x == float("-inf"))


def rules_gold(gold: DataFrame) -> DataFrame:
    log_ok = (F.round(F.col("amount_log"), 4)
              == F.round(F.ln(F.lit(1.0) + F.greatest(F.col("amount"), F.lit(0.0))), 4))
    flags_bad = F.lit(False)
    for f in GOLD_FLAGS:
        flags_bad = flags_bad | ~F.col(f).isin(0, 1) | F.col(f).isNull()
    num_bad = F.lit(False)
    for f in S.FEATURES:
        num_bad = num_bad | _bad_number(f)
    a = gold.agg(
        F.count_if(~log_ok | log_ok.isNull()).alias("log"),
        F.count_if(~F.col("tx_hour").between(0, 23)).alias("hour"),
        F.count_if(~F.col("tx_day_of_week").between(0, 6)).alias("dow"),
        F.count_if(flags_bad).alias("flags"),
        F.count_if(~F.col("rule_score").between(0, 1) | ~F.col("payment_type_risk").between(0, 1))
        .alias("range"),
        F.count_if(num_bad).alias("num"))
    return _rules(a, [
        ("amount_log_matches", F.col("log"), None),
        ("tx_hour_range", F.col("hour"), None),
        ("tx_day_of_week_range", F.col("dow"), None),
        ("binary_flags", F.col("flags"), None),
        ("score_and_risk_in_unit_range", F.col("range"), None),
        ("features_finite", F.col("num"), None),
    ])


def layer_drift(bronze: DataFrame, silver: DataFrame, max_drift: float = 0.01) -> DataFrame:
    b = bronze.agg(F.count(F.lit(1)).alias("n"), F.avg("Is Laundering").alias("r"))
    s = silver.agg(F.count(F.lit(1)).alias("n"), F.avg("is_laundering").alias("r"))
    row = s.select(F.col("n").alias("sn"), F.col("r").alias("sr"),
                   b.select("n").scalar().alias("bn"), b.select("r").scalar().alias("br"))
    return _rules(row, [
        ("silver_rows_le_bronze_rows", F.when(F.col("sn") <= F.col("bn"), 0).otherwise(1), None),
        ("label_rate_drift", F.when(F.abs(F.col("sr") - F.col("br")) < max_drift, 0).otherwise(1), None),
    ])


def contract_rules(unified: DataFrame, run_ts: str) -> DataFrame:
    """Quality rules of the data contract on the unified layout."""
    required = [c for c in S.UNIFIED_COLUMNS if c != "typology"]
    any_null = F.lit(False)
    for c in required:
        any_null = any_null | F.col(c).isNull()
    codes = list(S.CURRENCY_CODES.values())
    now = F.lit(run_ts.replace("T", " ")).cast("timestamp_ntz")
    ids = _per_id(unified, "transaction_id", {
        "_null": any_null,
        "_neg": F.col("amount") < 0,
        "_cur": ~F.col("payment_currency").isin(*codes) | ~F.col("receiving_currency").isin(*codes),
        "_fut": F.col("timestamp") > now,
    })
    a = ids.agg(F.sum("_null").alias("null"), F.sum("_neg").alias("neg"), F.sum("_cur").alias("cur"),
                F.sum("_fut").alias("fut"), F.count_if(F.col("_copies") > 1).alias("dup"))
    return _rules(a, [
        ("no_null_in_required_fields", F.col("null"), None),
        ("amount_positive", F.col("neg"), None),
        ("valid_currency_codes", F.col("cur"), None),
        ("timestamp_not_future", F.col("fut"), None),
        ("no_duplicate_transaction_id", F.col("dup"), None),
    ])


def contract_sla(bronze: DataFrame, clean: DataFrame,
                 max_delay_minutes: float = S.SLA_MAX_DELAY_MINUTES,
                 min_completeness_pct: float = S.SLA_MIN_COMPLETENESS_PCT,
                 max_error_rate_pct: float = S.SLA_MAX_ERROR_RATE_PCT) -> DataFrame:
    """Ingestion delay (max of ingested_at − transaction time, minutes),
    completeness (clean / all rows %) and error rate (dead / all rows %)."""
    ts = C.parse_timestamp("Timestamp")
    ing = F.to_timestamp_ntz(F.col("ingested_at"))
    delay = F.timestamp_diff("SECOND", ts, ing) / 60.0
    b = bronze.agg(F.count(F.lit(1)).alias("n"), F.max(delay).alias("delay"))
    c = clean.agg(F.count(F.lit(1)).alias("n"))
    row = b.select(F.col("n").alias("total"), F.col("delay"), c.select("n").scalar().alias("ok"))
    complete = C.pct("ok", "total", 4)
    error = C.pct(F.col("total") - F.col("ok"), "total", 4)
    return row.select(
        C.round_half_up("delay", 4).alias("max_ingestion_delay_minutes"),
        complete.alias("completeness_pct"), error.alias("error_rate_pct"),
        (F.col("delay") <= max_delay_minutes).alias("delay_ok"),
        (complete >= min_completeness_pct).alias("completeness_ok"),
        (error <= max_error_rate_pct).alias("error_rate_ok"))


def gate_bronze(bronze: DataFrame) -> DataFrame:
    """Required columns present (schema check covering every file read)."""
    spark = bronze.sparkSession
    present = set(bronze.columns)
    rows = [(c, c in present) for c in S.BRONZE_REQUIRED]
    return spark.createDataFrame(rows, "column string, present boolean").withColumn(
        "row_count", bronze.agg(F.count(F.lit(1))).scalar())


def gate_bronze_files(spark, path: str, min_files: int = 1, by_folder: bool = False) -> DataFrame:
    """Gate over the files of a written bronze layer: their number, and for
    each required column in how many files it is missing (no row of the file
    has a value there). Files are counted by Spark, not listed on the driver.

    ``by_folder``: what many tasks wrote into one folder counts as one, and lacks
    a column if any of its files does."""
    layer = spark.read.option("mergeSchema", True).parquet(path)
    required = [c for c in S.BRONZE_REQUIRED if c in layer.columns]
    per_file = layer.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        *[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(required)])
    if by_folder:
        per_file = per_file.groupBy(F.regexp_replace("file", "/[^/]*$", "").alias("file")).agg(
            *[F.min(f"_c{i}").alias(f"_c{i}") for i in range(len(required))])
    a = per_file.agg(F.count(F.lit(1)).alias("files"),
                     *[F.count_if(F.col(f"_c{i}") == 0).alias(f"_c{i}") for i in range(len(required))])
    rules = [("min_files", F.when(F.col("files") < min_files, 1).otherwise(0), None)]
    for c in S.BRONZE_REQUIRED:
        missing = F.col(f"_c{required.index(c)}") if c in required else F.greatest(F.col("files"), F.lit(1))
        rules.append((f"files_without_{c.lower().replace(' ', '_')}", missing, None))
    return _rules(a, rules)
