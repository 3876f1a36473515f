"""The layered pipeline: bronze -> clean/dead -> silver -> gold -> alerts.

``Ledger`` builds each layer lazily, once per (session, input folder, run
time). Bronze (with each row's time, bad mark and hash of its id), the marks of
silver's duplicates, gold, alerts and the status-applied alerts are materialised
once as written tables in the shared checkpoint folder, so later queries read
the written layer instead of re-shuffling the whole lineage, and a lost
executor never forces recomputation from the raw tables. Silver's rows are made
of the bronze rows, one by one, when they are read. The layers are
written as Parquet under ``spark.checkpoint.dir``, so reads of them prune
columns and push filters down.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwatch import schemas as S
from txwatch.functions import rules as R
from txwatch.operators import alerts as A
from txwatch.operators import features as FE
from txwatch.operators import ingest as I
from txwatch.operators import standardize as ST
from txwatch.session import materialize, session_key, shuffles_for
from txwatch.sources import testdata as TD


class Ledger:
    def __init__(self, spark: SparkSession, sf_dir: str, run_ts: str = TD.DEFAULT_RUN_TS,
                 persist: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.run_ts = run_ts
        self.persist = persist

    def _keep(self, df: DataFrame, name: str, sort_within: str | None = None) -> DataFrame:
        if not self.persist:
            return df
        with shuffles_for(self.spark, self.lines):
            return materialize(df, name, sort_within, codec="zstd")

    @cached_property
    def lines(self) -> int:
        """Rows of ``lineitem`` (from the files' footers); the layers have about as many."""
        return TD.read_table(self.spark, self.sf_dir, "lineitem").count()

    # --- bronze ---------------------------------------------------------
    @cached_property
    def _raw(self) -> DataFrame:
        return TD.ledger_bronze(self.spark, self.sf_dir, self.run_ts)

    @cached_property
    def _rows(self) -> DataFrame:
        """Bronze rows, their times, bad marks and ids' hashes: the one table of all
        rows; silver's other columns are made of it when it is read."""
        rows = ST.to_stored(self._raw, I.is_bad_row(ts_text=None), TD.SAME)
        return ST.from_stored(self._keep(rows, "bronze"), self._raw.columns, TD.SAME)

    @cached_property
    def bronze(self) -> DataFrame:
        return self._rows.select(*self._raw.columns) if self.persist else self._raw

    @cached_property
    def _split(self) -> tuple[DataFrame, DataFrame]:
        if not self.persist:
            return I.split_dead_letter(self.bronze)
        bad = F.col(ST.BAD)
        return tuple(self._rows.where(part).select(*self._raw.columns) for part in (~bad, bad))

    @property
    def clean(self) -> DataFrame:
        return self._split[0]

    @property
    def dead_letter(self) -> DataFrame:
        return self._split[1]

    # --- silver ---------------------------------------------------------
    @cached_property
    def standardized(self) -> DataFrame:
        return ST.standardize(self._rows.where(~F.col(ST.BAD)) if self.persist else self.clean)

    @cached_property
    def _dedup(self) -> DataFrame:
        first = ST.packed_ordinal(TD.ORDINAL_DIGITS)
        if not self.persist:
            return ST.mark_duplicates(self.standardized, order_key=first)
        # what follows from other columns is neither written nor moved, but made when it is read
        marked = ST.mark_stored_duplicates(
            self._rows.where(~F.col(ST.BAD)), lambda rows: ST.standardize(rows).drop(*ST.DERIVED),
            lambda df: self._keep(df, "silver-again"), order_key=first)
        return ST.with_derived(marked).select(*self.standardized.columns, "dead_reason")

    @property
    def silver(self) -> DataFrame:
        return (self._dedup.where(F.col("dead_reason").isNull())
                .select(*S.SILVER_COLUMNS))

    @property
    def silver_dead(self) -> DataFrame:
        return self._dedup.where(F.col("dead_reason").isNotNull())

    # --- gold -----------------------------------------------------------
    @cached_property
    def gold(self) -> DataFrame:
        gold = FE.gold_features(self.silver, derive=True)
        if not self.persist:
            return gold
        kept = self._keep(gold.drop(*ST.DERIVED, "amount_vs_sender_avg"), "gold", sort_within="transaction_id")
        return ST.with_derived(kept).withColumn("amount_vs_sender_avg", R.amount_vs_sender_avg()).select(*S.GOLD_COLUMNS)

    @cached_property
    def alerts(self) -> DataFrame:
        return self._keep(A.generate_alerts(self.gold, self.run_ts), "alerts")

    @property
    def scores(self) -> DataFrame:
        """Rule-based scores in the score-table layout (probability = score)."""
        return self.gold.select(
            "transaction_id",
            F.col("rule_score").alias("ml_probability"),
            F.col("rule_score").alias("final_risk_score"))

    @property
    def status_changes(self) -> DataFrame:
        """A status change log derived from the alerts (grows with them):
        ids starting 0-4 -> 'investigating' (lower case) after 1h; ids
        starting 4-5 -> CLOSED after 2h (so '4' has two updates, the later
        wins); 'a' -> an invalid status; 'b' -> an unknown alert id."""
        a = self.alerts.select("alert_id", "created_at")
        first = F.substring("alert_id", 1, 1)
        t1 = F.col("created_at") + F.expr("INTERVAL 1 HOUR")
        t2 = F.col("created_at") + F.expr("INTERVAL 2 HOURS")
        rows = [
            a.where(first.isin("0", "1", "2", "3", "4"))
             .select("alert_id", F.lit("investigating").alias("status"), t1.alias("changed_at")),
            a.where(first.isin("4", "5"))
             .select("alert_id", F.lit("CLOSED").alias("status"), t2.alias("changed_at")),
            a.where(first == "a")
             .select("alert_id", F.lit("ESCALATED").alias("status"), t1.alias("changed_at")),
            a.where(first == "b")
             .select(F.concat(F.lit("missing-"), "alert_id").alias("alert_id"),
                     F.lit("CLOSED").alias("status"), t1.alias("changed_at")),
        ]
        out = rows[0]
        for r in rows[1:]:
            out = out.unionByName(r)
        return out.select("alert_id", "status",
                          F.col("changed_at").cast(T.TimestampNTZType()).alias("changed_at"))

    @cached_property
    def _status(self) -> tuple[DataFrame, DataFrame]:
        return A.apply_status_changes(self.alerts, self.status_changes)

    @cached_property
    def alerts_current(self) -> DataFrame:
        return self._keep(self._status[0], "alerts-current")

    @property
    def status_rejected(self) -> DataFrame:
        return self._status[1]


_LEDGERS: dict[tuple, Ledger] = {}


def ledger(spark: SparkSession, sf_dir: str, run_ts: str = TD.DEFAULT_RUN_TS) -> Ledger:
    """The shared ``Ledger`` for this session, folder and input files (built
    once; other files in the folder make a new one)."""
    files = [f for t in ("lineitem", "orders", "customer", "supplier")
             for f in TD.read_table(spark, sf_dir, t).inputFiles()]
    key = (session_key(spark), sf_dir.rstrip("/"), run_ts, tuple(sorted(files)))
    if key not in _LEDGERS:
        _LEDGERS[key] = Ledger(spark, sf_dir, run_ts)
    return _LEDGERS[key]
