"""Contract-driven reading and gating, broken lines, and exports that are read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from txwatch import schemas as S
from txwatch.operators import alerts as A
from txwatch.operators import analytics as AN
from txwatch.operators import contract as K
from txwatch.operators import ingest as I
from txwatch.operators import quality as Q
from txwatch.operators.clustered import ClusteredLayer
from txwatch.oracle import CHANGED_NOW, CREATED_AT, RUN_TS, STATUS_NOW, with_layers
from txwatch.plans import publish as P
from txwatch.plans.catalog import register
from txwatch.plans.pipeline import ledger
from txwatch.plans.queries_more import UNIFIED_SQL, _cte, _unified
from txwatch.plans.queries_reports import r4
from txwatch.plans.status_log import StatusLog
from txwatch.plans.versions import VersionedLayer
from txwatch.session import materialize, scratch_path
from txwatch.sources import testdata as TD

CODES = ", ".join(f"'{c}'" for c in S.CURRENCY_CODES.values())


def _gate_sql() -> str:
    required = [c for c in S.UNIFIED_COLUMNS if c != "typology"]
    rows = [(f"{c}_required", f"count_if({c} IS NULL)") for c in required]
    rows += [("amount_at_least_0", "count_if(amount < 0)"), ("is_laundering_one_of", "count_if(is_laundering NOT IN (0, 1))"),
             ("source_one_of", f"count_if(source NOT IN ('{S.SOURCE_IBM}', '{S.SOURCE_SAML}'))"),
             ("valid_currency_codes", f"count_if(payment_currency NOT IN ({CODES}) OR receiving_currency NOT IN ({CODES}))"),
             ("timestamp_not_future", f"count_if(timestamp > TIMESTAMP '{RUN_TS.replace('T', ' ')}')")]
    aggs = ", ".join(f"{v} AS v{i}" for i, (_, v) in enumerate(rows))
    out = [f"SELECT '{n}' AS rule, CAST(v{i} AS BIGINT) AS violations, v{i} = 0 AS passed FROM a" for i, (n, _) in enumerate(rows)]
    out.append("SELECT 'transaction_id_unique', count(*), count(*) = 0 FROM (SELECT transaction_id FROM unified GROUP BY 1 HAVING count(*) > 1)")
    return _cte(UNIFIED_SQL + f",\na AS (SELECT {aggs} FROM unified)\n" + "\nUNION ALL ".join(out), "silver")


@register("contract_gate", _gate_sql())
def contract_gate(spark, sf):
    """Every rule that the contract implies, one row each, on both sources."""
    return K.Contract(K.default_contract()).gate(_unified(spark, sf), RUN_TS)


@register("second_source_csv", _cte(UNIFIED_SQL + "\nSELECT * FROM unified WHERE source = 'saml_d'", "silver"))
def second_source_csv(spark, sf):
    """The second source as a CSV file, read and mapped as the contract says."""
    path = scratch_path(spark, "second-source")
    TD.saml_source(spark, sf).write.option("header", True).csv(path)
    contract = K.Contract(K.default_contract())
    rows, _ = K.fit_lines(materialize(contract.read(spark, path, S.SOURCE_SAML), "second-source"))
    return contract.unified(rows, S.SOURCE_SAML)


#: Lines of the raw file that are broken on purpose: cut short, with a field too many, with text for a number.
BREAKS = {"cut short": 101, "a field too many": 103, "text for a number": 107}


def _broken(key: str) -> str:
    arms = " ".join(f"WHEN {key} % {n} = 0 THEN '{name}'" for name, n in BREAKS.items())
    return f"CASE {arms} END"


@register("csv_broken_lines", with_layers(f"""
SELECT CASE WHEN b IS NOT NULL THEN 'broken' WHEN is_bad THEN 'dead letter' ELSE 'kept' END AS route, b AS how, COUNT(*) AS lines
FROM (SELECT *, {_broken('src_orderkey')} AS b FROM bronze_flag) GROUP BY 1, 2""", "silver"))
def csv_broken_lines(spark, sf):
    """A raw file with broken lines: what is kept, what goes to the dead letter, and
    the broken lines by what is wrong with them, from the lines' own text."""
    names = [f.name for f in S.BRONZE_CSV_SCHEMA.fields]
    field = {n: F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")) for n in names}
    how = F.expr(_broken("src_orderkey"))
    whole = F.concat_ws(",", *field.values())
    line = (F.when(how == "cut short", F.concat_ws(",", *list(field.values())[:5]))
            .when(how == "a field too many", F.concat(whole, F.lit(",extra")))
            .when(how == "text for a number", F.concat_ws(",", *[F.lit("no number") if n == "Amount Paid" else v for n, v in field.items()]))
            .otherwise(whole))
    path = scratch_path(spark, "raw-lines")
    ledger(spark, sf).bronze.select(line.alias("value")).write.text(path)
    contract = K.Contract({"sources": {"raw": {"columns": {f.name: {"type": "float" if "Amount" in f.name else "integer" if f.name == "Is Laundering" else "string"}
                                                            for f in S.BRONZE_CSV_SCHEMA.fields}}}})
    rows, broken = K.fit_lines(materialize(contract.read(spark, path, "raw", header=False), "raw-lines"))
    routed = rows.select(F.when(I.is_bad_row(), "dead letter").otherwise("kept").alias("route"), F.lit(None).cast("string").alias("how"))
    n = F.size(F.split("line", ","))
    kinds = broken.select(F.lit("broken").alias("route"), F.when(n < len(names), "cut short").when(n > len(names), "a field too many")
                          .otherwise("text for a number").alias("how"))
    return routed.unionByName(kinds).groupBy("route", "how").agg(F.count(F.lit(1)).alias("lines"))


@register("alert_export_csv", with_layers(f"""
SELECT alert_id, substr(alert_id, 1, 8) AS alert_short_id, transaction_id, {r4('rule_score')} AS risk_score,
       hit_typology AS typology, {STATUS_NOW} AS status, strftime({CREATED_AT}, '%Y-%m-%d %H:%M') AS created_at FROM hits""", "hits"))
def alert_export_csv(spark, sf):
    """The export as the CSV files that are handed out, read back."""
    export = AN.alert_export(ledger(spark, sf).alerts_current)
    path = scratch_path(spark, "alert-export")
    P.export_alerts_csv(export, path)
    return spark.read.schema(export.schema).option("header", True).csv(path)


_FILES = """, f AS (SELECT COUNT(DISTINCT chunk_id) AS files FROM bronze)
SELECT 'min_files' AS rule, CAST(CASE WHEN files < 5 THEN 1 ELSE 0 END AS BIGINT) AS violations, files >= 5 AS passed FROM f
""" + "\n".join(
    f"UNION ALL SELECT 'files_without_{c.lower().replace(' ', '_')}', CAST({'1' if c == 'To Bank' else '0'} AS BIGINT), "
    f"{'false' if c == 'To Bank' else 'true'} FROM f" for c in S.BRONZE_REQUIRED)


@register("gate_bronze_files", with_layers(_FILES, "bronze").replace("\n, f AS", ",\nf AS", 1))
def gate_bronze_files(spark, sf):
    """The gate over written files, one folder a chunk, of which one lacks a column."""
    bronze, path = ledger(spark, sf).bronze, scratch_path(spark, "bronze-files")
    for chunk in sorted(r.chunk_id for r in bronze.select("chunk_id").distinct().collect()):
        part = bronze.where(F.col("chunk_id") == chunk)
        (part.drop("To Bank") if chunk == 1 else part).write.parquet(f"{path}/chunk={chunk}")
    return Q.gate_bronze_files(spark, path, min_files=5, by_folder=True)


#: Output partitions that are written where the rows are: a year of months of one source.
FEW = 12


@register("published_silver", with_layers(f"SELECT {', '.join(S.SILVER_COLUMNS)} FROM silver", "silver"))
def published_silver(spark, sf):
    """Silver as a published version: a first version, one that fails its gate, and the whole layer."""
    silver = ledger(spark, sf).silver
    layer = VersionedLayer(spark, scratch_path(spark, "published"))
    first = layer.publish(silver.where(F.col("is_laundering") == 1), ("source", "year", "month"), few=FEW)
    try:
        layer.publish(silver.withColumn("amount", -F.col("amount")), ("source", "year", "month"), gate=lambda df: Q.gate_silver(df, 1), expected=first, few=FEW)
    except Exception as e:  # noqa: BLE001 - the gate's own error
        if "non_negative" not in str(e) and "negative" not in str(e):
            raise
    layer.publish(silver, ("source", "year", "month"), gate=lambda df: Q.gate_silver(df, 1), expected=first, few=FEW)
    return layer.read().select(*S.SILVER_COLUMNS)


def _pages(spark, sf) -> ClusteredLayer:
    """Current alerts by falling score and id, in files of a thousand."""
    alerts = ledger(spark, sf).alerts_current.select(
        (-F.col("risk_score")).alias("rank"), "alert_id", "transaction_id", "risk_score", "typology", "status", "created_at")
    layer = ClusteredLayer(spark, scratch_path(spark, "alert-pages"), ("rank", "alert_id"))
    layer.write(alerts, rows_per_file=1000)
    return layer


ALERT_SQL = f"""alert_id, transaction_id, rule_score AS risk_score, hit_typology AS typology, {STATUS_NOW} AS status, {CREATED_AT} AS created_at"""


@register("alert_page", with_layers(f"SELECT {ALERT_SQL} FROM hits ORDER BY rule_score DESC, alert_id LIMIT 100 OFFSET 200", "hits"))
def alert_page(spark, sf):
    """The third page of a hundred alerts, by the cursor of the page before."""
    layer, after = _pages(spark, sf), None
    for _ in range(2):
        after = layer.cursor(layer.page(after, 100))
    return layer.page(after, 100).drop("rank")


@register("alert_lookup", with_layers(f"SELECT {ALERT_SQL} FROM hits ORDER BY alert_id DESC LIMIT 1", "hits"))
def alert_lookup(spark, sf):
    """One alert by its id (the key is taken from the data) from the one file that may hold it."""
    alerts = ledger(spark, sf).alerts_current.drop("updated_at")
    layer = ClusteredLayer(spark, scratch_path(spark, "alerts-by-id"), ("alert_id",))
    layer.write(alerts, rows_per_file=1000)
    return layer.lookup((alerts.agg(F.max("alert_id")).first()[0],))


@register("status_log_current", with_layers(f"""
SELECT alert_id, transaction_id, rule_score AS risk_score, hit_typology AS typology, {STATUS_NOW} AS status,
       {CREATED_AT} AS created_at, {CHANGED_NOW} AS updated_at FROM hits""", "hits"))
def status_log_current(spark, sf):
    """Alerts with their status from a snapshot and a tail: the later changes come first,
    one segment comes twice, and the log is compacted in between."""
    lg, log = ledger(spark, sf), StatusLog(spark, scratch_path(spark, "status-log"))
    changes = lg.status_changes
    late = changes.where(F.col("status") == "CLOSED")
    log.append(late)
    log.append(changes.where(F.col("status") != "CLOSED"))
    log.compact()
    log.append(late)
    return A.apply_status_changes(lg.alerts, log.latest())[0]
