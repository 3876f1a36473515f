"""Model reports by split (the decision threshold comes from val and holds for
both), percentiles of a dense score, and Shapley values."""

from __future__ import annotations

from pyspark.sql import functions as F

from txwatch import schemas as S
from txwatch.operators import id_index as IX
from txwatch.operators import metrics as M
from txwatch.operators import ml as ML
from txwatch.operators import selection as SEL
from txwatch.operators import shap as SH
from txwatch.oracle import with_layers
from txwatch.plans.catalog import register
from txwatch.plans.pipeline import ledger
from txwatch.plans.queries_more import _model
from txwatch.session import materialize, scratch_path

BY = ("split",)


def _splits(spark, sf):
    ds = ML.ml_dataset(ledger(spark, sf).gold)
    return ds.where(F.col("split") != "train").select("split", F.col("rule_score").alias("score"), F.col(S.TARGET).alias("label"))


def _val_threshold(spark, sf):
    val = _splits(spark, sf).where(F.col("split") == "val")
    return M.best_threshold(M.threshold_sweep(val)).select("threshold").scalar()


def _sd(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)"


_SWEEP = f"""
ev AS (SELECT CASE WHEN timestamp <= TIMESTAMP '{S.VAL_END}' THEN 'val' ELSE 'test' END AS split, rule_score AS score, is_laundering AS label
       FROM gold WHERE timestamp > TIMESTAMP '{S.TRAIN_END}'),
cuts AS (SELECT CAST(i AS DOUBLE) / 20 AS threshold FROM range(1, {S.SWEEP_STEPS + 1}) r(i)),
sw0 AS (SELECT split, threshold, count_if(score >= threshold) AS pp, count_if(score >= threshold AND label = 1) AS tp,
               count_if(label = 1) AS p, count(*) AS n FROM ev, cuts GROUP BY split, threshold),
sw AS (SELECT split, threshold, CAST(pp AS BIGINT) AS predicted_pos, CAST(tp AS BIGINT) AS tp, CAST(pp - tp AS BIGINT) AS fp,
              CAST(p - tp AS BIGINT) AS fn, {_sd('tp', 'pp')} AS precision, {_sd('tp', 'p')} AS recall, {_sd('2 * tp', 'p + pp')} AS f1,
              CAST(round(CAST({_sd('pp', 'n')} * 100 AS DECIMAL(38,12)), 2) AS DOUBLE) AS flagged_pct FROM sw0),
best AS (SELECT coalesce((SELECT threshold FROM sw WHERE split = 'val' AND f1 > 0 ORDER BY f1 DESC, threshold LIMIT 1), 0.5) AS best_at)"""
_CM = """,
cm AS (SELECT split, CAST(count_if(score < best_at AND label <> 1) AS BIGINT) AS tn, CAST(count_if(score >= best_at AND label <> 1) AS BIGINT) AS fp,
              CAST(count_if(score < best_at AND label = 1) AS BIGINT) AS fn, CAST(count_if(score >= best_at AND label = 1) AS BIGINT) AS tp
       FROM ev, best GROUP BY split)"""


def _sql(body: str) -> str:
    return with_layers("@" + body, "gold").replace("\n@", ",", 1)


@register("threshold_sweep_by_split", _sql(_SWEEP + "\nSELECT * FROM sw"))
def threshold_sweep_by_split(spark, sf):
    return M.threshold_sweep(_splits(spark, sf), by=BY)


@register("confusion_matrix_by_split", _sql(_SWEEP + _CM + "\nSELECT * FROM cm"))
def confusion_matrix_by_split(spark, sf):
    return M.confusion(_splits(spark, sf), _val_threshold(spark, sf), by=BY)


@register("classification_metrics_by_split", _sql(_SWEEP + _CM + f"""
SELECT *, {_sd('tp', 'tp + fp')} AS precision, {_sd('tp', 'tp + fn')} AS recall, {_sd('2 * tp', '2 * tp + fp + fn')} AS f1 FROM cm"""))
def classification_metrics_by_split(spark, sf):
    return M.from_confusion(confusion_matrix_by_split(spark, sf))


@register("classification_report_by_split", _sql(_SWEEP + _CM + f""",
rp AS (SELECT *, {_sd('tn', 'tn + fn')} AS p0, {_sd('tn', 'tn + fp')} AS r0, {_sd('2 * tn', '2 * tn + fn + fp')} AS f0,
              {_sd('tp', 'tp + fp')} AS p1, {_sd('tp', 'tp + fn')} AS r1, {_sd('2 * tp', '2 * tp + fp + fn')} AS f1,
              tn + fp AS s0, tp + fn AS s1, tn + fp + tp + fn AS n FROM cm)
SELECT split, '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM rp
UNION ALL SELECT split, '1', p1, r1, f1, s1 FROM rp
UNION ALL SELECT split, 'accuracy', NULL, NULL, {_sd('tp + tn', 'n')}, n FROM rp
UNION ALL SELECT split, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM rp
UNION ALL SELECT split, 'weighted avg', p0 * {_sd('s0', 'n')} + p1 * {_sd('s1', 'n')}, r0 * {_sd('s0', 'n')} + r1 * {_sd('s1', 'n')},
                 f0 * {_sd('s0', 'n')} + f1 * {_sd('s1', 'n')}, n FROM rp"""))
def classification_report_by_split(spark, sf):
    return M.classification_report(confusion_matrix_by_split(spark, sf), by=BY)


@register("model_gate_by_split", _sql(_SWEEP + _CM + f""",
g0 AS (SELECT split, score, count_if(label = 1) AS pos, count_if(label <> 1) AS neg FROM ev GROUP BY split, score),
g AS (SELECT *, SUM(neg) OVER (PARTITION BY split ORDER BY score) - neg AS neg_below,
      SUM(pos) OVER (PARTITION BY split) AS P, SUM(neg) OVER (PARTITION BY split) AS N FROM g0),
v AS (SELECT split, 'auc_roc' AS metric, SUM(CAST(pos AS DOUBLE) * (CAST(neg_below AS DOUBLE) + neg * 0.5)) / (CAST(max(P) AS DOUBLE) * max(N)) AS value,
             CAST({S.GATE_MIN_AUC} AS DOUBLE) AS minimum FROM g GROUP BY split
      UNION ALL SELECT split, 'recall', {_sd('tp', 'tp + fn')}, {S.GATE_MIN_RECALL} FROM cm)
SELECT split, metric, round(value, 10) AS value, minimum, coalesce(value >= minimum, false) AS passed FROM v"""))
def model_gate_by_split(spark, sf):
    """The gate on val and on test (AUC from the rule score, recall at the val threshold)."""
    scored, recall = _splits(spark, sf), classification_metrics_by_split(spark, sf)
    out = None
    for split in ("val", "test"):
        auc = M.auc_roc(scored.where(F.col("split") == split)).scalar()
        mine = recall.where(F.col("split") == split).select("recall").scalar()
        gate = M.model_gate(auc, mine, spark=spark).withColumn("value", F.round("value", 10)).withColumn("split", F.lit(split))
        out = gate if out is None else out.unionByName(gate)
    return out


SHARES = (0.01, 0.5, 0.9, 0.99, 0.999)


@register("dense_percentiles", with_layers(f"""@
r AS (SELECT score, row_number() OVER (ORDER BY score) - 1 AS i, CAST(count(*) OVER () - 1 AS DOUBLE) AS last FROM (
        SELECT CAST('0x' || substr(md5(transaction_id), 1, 13) AS BIGINT) / 4503599627370496.0 AS score FROM gold)),
q AS (SELECT unnest([{', '.join(map(str, SHARES))}])::DOUBLE AS share)
SELECT share, CASE WHEN min(score) = max(score) THEN min(score)
                   ELSE (ceil(any_value(last * share)) - any_value(last * share)) * min(score)
                        + (any_value(last * share) - floor(any_value(last * share))) * max(score) END AS value
FROM r, q WHERE i = floor(last * share) OR i = ceil(last * share) GROUP BY share""", "gold").replace("\n@", ",", 1))
def dense_percentiles(spark, sf):
    """Exact percentiles of a score with as many values as rows (a hash of the id)."""
    dense = F.conv(F.substring(F.md5("transaction_id"), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))
    scores = materialize(ledger(spark, sf).gold.select(dense.alias("score")), "dense-scores")  # each id is hashed once
    return spark.createDataFrame(list(zip(SHARES, SEL.percentiles_exact(scores, "score", SHARES))), "share double, value double")


@register("shap_importance")
def shap_importance(spark, sf):
    """Mean absolute Shapley value of each feature over all val and test rows."""
    ds = ML.ml_dataset(ledger(spark, sf).gold)
    return SH.shap_importance(_model(spark, sf), ds.where(F.col("split") != "train"))


INC = ("transaction_id", "chunk_id", "copy_no")


def _indexed(spark, sf):
    """Chunk by chunk: the ids of chunks 0 to 2 are loads of the index, chunk 3 asks it."""
    lg = ledger(spark, sf)
    index = IX.IdIndex(spark, scratch_path(spark, "id-index"))
    published = lg._dedup.where(F.col("dead_reason").isNull())
    index.add(published.where(F.col("chunk_id") <= 1), "transaction_id")
    index.add(published.where(F.col("chunk_id") == 2), "transaction_id")
    return index.split(lg.standardized.where(F.col("chunk_id") >= 3), "transaction_id")


def _first_chunk_sql(test: str) -> str:
    cols = ", ".join(INC)
    return with_layers(f"""
SELECT {cols} FROM (SELECT {cols}, MIN(chunk_id) OVER (PARTITION BY transaction_id) AS first_chunk FROM std)
WHERE chunk_id >= 3 AND first_chunk {test}""", "silver")


@register("indexed_new_rows", _first_chunk_sql("> 2"))
def indexed_new_rows(spark, sf):
    """Rows of the last chunk whose ids the written index does not hold."""
    return _indexed(spark, sf)[0].select(*INC)


@register("indexed_seen_rows", _first_chunk_sql("<= 2"))
def indexed_seen_rows(spark, sf):
    """Rows of the last chunk whose ids the written index holds."""
    return _indexed(spark, sf)[1].select(*INC)
