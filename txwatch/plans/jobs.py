"""The batch job: raw rows -> bronze -> silver -> gold -> alerts on storage.

Each layer is written, gated and published before the next one reads it,
so lineage is cut at every layer by a written table (a lost executor never
recomputes from the raw input) and reruns with the same ``run_ts`` give the
same ids. Counts for the audit come from ``observe`` on the writes.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch import schemas as S
from txwatch.operators import alerts as A
from txwatch.operators import features as FE
from txwatch.operators import ingest as I
from txwatch.operators import quality as Q
from txwatch.operators import standardize as ST
from txwatch.plans import publish as P
from txwatch.session import materialize
from txwatch.sources.files import read_layer

RAW_COLUMNS = [f.name for f in S.BRONZE_CSV_SCHEMA.fields] + ["ingested_at", "source"]


def run_pipeline(spark: SparkSession, raw: DataFrame, root: str, run_id: str, run_ts: str,
                 min_rows: int = 1, percentile: float = S.ALERT_PERCENTILE) -> dict:
    """Run every layer; returns the layer paths and the audit rows' path. A run
    that fails appends the rows of the layers it finished and a failed one."""
    root = root.rstrip("/")
    done: list[DataFrame] = []
    try:
        return _run(spark, raw, root, run_id, run_ts, min_rows, percentile, done)
    except Exception as e:
        layer = ("bronze", "silver", "gold", "alerts")[min(len(done), 3)]
        failed = P.audit_row(spark, layer, run_id, "run", layer, "failed", 0, 0, time.time(), error=str(e)[:2000])
        _append(done + [failed], f"{root}/audit")
        raise


def _append(rows: list[DataFrame], path: str) -> None:
    out = rows[0]
    for a in rows[1:]:
        out = out.unionByName(a)
    P.append_audit(out, path)


def _run(spark: SparkSession, raw: DataFrame, root: str, run_id: str, run_ts: str, min_rows: int,
         percentile: float, audit: list[DataFrame]) -> dict:
    paths = {k: f"{root}/{k}" for k in ("bronze", "bronze_dead", "silver", "silver_dead",
                                         "gold", "alerts", "audit")}
    # Bronze: partitioned by transaction year/month, then read back so the
    # file order defines "first copy" for dedup.
    t0 = time.time()
    P.write_bronze(raw.select(*RAW_COLUMNS), paths["bronze"])
    Q.raise_if_failed(Q.gate_bronze_files(spark, paths["bronze"]))
    bronze = read_layer(spark, paths["bronze"]).drop("year", "month")
    clean, dead = I.split_dead_letter(bronze)
    dead = dead.drop("chunk_id", "row_in_chunk").withColumn("dead_reason", I.dead_letter_reason())
    m_dead = P.observed_write(dead, paths["bronze_dead"], None)
    audit.append(P.audit_row(spark, "bronze", run_id, "split_dead_rows", "bronze", "success",
                             bronze.count(), m_dead["rows"], t0))

    # Silver: standardise, dedup (file order, then row order), staged publish.
    t0 = time.time()
    marked = ST.mark_duplicates(ST.standardize(clean), order_cols=["row_in_chunk"])
    # one pass over the duplicates' join: both sides read the written rows
    marked = materialize(marked, "silver-marked")
    silver = marked.where(F.col("dead_reason").isNull()).select(*S.SILVER_COLUMNS)
    report = P.publish_staged(silver, f"{root}/_staging/{run_id}/silver", paths["silver"],
                              gate=lambda d: Q.gate_silver(d, min_rows),
                              partition_cols=("source", "year", "month"))
    m_sd = P.observed_write(marked.where(F.col("dead_reason").isNotNull()), paths["silver_dead"])
    silver_pub = spark.read.parquet(paths["silver"]).select(*S.SILVER_COLUMNS)
    counts = silver_pub.agg(F.count(F.lit(1)).alias("n"), F.sum("is_laundering").alias("p")).first()
    audit.append(P.audit_row(spark, "silver", run_id, "build_silver", "silver", "success",
                             counts["n"], m_sd["rows"], t0, counts["p"]))

    # Gold: windows and rule score from the published silver, staged publish.
    t0 = time.time()
    gold = FE.gold_features(silver_pub)
    P.publish_staged(gold, f"{root}/_staging/{run_id}/gold", paths["gold"],
                     gate=lambda d: Q.gate_gold(d, min_rows))
    gold_pub = spark.read.parquet(paths["gold"]).select(*S.GOLD_COLUMNS)
    n_gold = gold_pub.count()
    audit.append(P.audit_row(spark, "gold", run_id, "build_gold", "gold", "success",
                             n_gold, 0, t0))

    # Alerts: full refresh from the published gold.
    t0 = time.time()
    m_al = P.observed_write(A.generate_alerts(gold_pub, run_ts, percentile), paths["alerts"], None)
    audit.append(P.audit_row(spark, "gold", run_id, "type_alerts", "alerts", "success",
                             m_al["rows"], 0, t0))

    _append(audit, paths["audit"])
    paths["silver_gate"] = report
    return paths
