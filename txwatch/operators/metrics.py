"""Binary-classification metrics as aggregates (no scores are collected).

Counts are cast to double before arithmetic (decimal literals would
truncate). AUC and average precision need, per distinct score, the number
of positives/negatives strictly below it. That prefix sum runs in two
levels: distinct scores fall into at most ``BUCKETS`` ordered buckets, by
bounds fetched once, whose totals get a prefix over a bounded table, and each
bucket orders its own distinct scores, so no step sees all scores in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwatch import schemas as S
from txwatch.session import materialize

BUCKETS = 256


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _safe_div(a, b) -> Column:
    return F.coalesce(F.try_divide(_d(a), _d(b)), F.lit(0.0))


def confusion(df: DataFrame, threshold, score: str = "score", label: str = "label", by: tuple[str, ...] = ()) -> DataFrame:
    """One row tn, fp, fn, tp at ``score >= threshold`` (a number or a column), for each value of ``by``."""
    thr = threshold if isinstance(threshold, Column) else F.lit(threshold)
    pred = F.col(score) >= thr
    pos = F.col(label) == 1
    return df.groupBy(*by).agg(
        F.count_if(~pred & ~pos).alias("tn"), F.count_if(pred & ~pos).alias("fp"),
        F.count_if(~pred & pos).alias("fn"), F.count_if(pred & pos).alias("tp"))


def from_confusion(cm: DataFrame) -> DataFrame:
    """precision, recall, f1 (0 when undefined) next to the counts."""
    return cm.select(
        "*",
        _safe_div("tp", F.col("tp") + F.col("fp")).alias("precision"),
        _safe_div("tp", F.col("tp") + F.col("fn")).alias("recall"),
        _safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def classification_report(cm: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Per class (0, 1) precision/recall/f1/support, accuracy, macro and
    weighted averages, from each confusion row."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    p1, r1, f1 = (_safe_div(tp, tp + fp), _safe_div(tp, tp + fn),
                  _safe_div(2 * tp, 2 * tp + fp + fn))
    p0, r0, f0 = (_safe_div(tn, tn + fn), _safe_div(tn, tn + fp),
                  _safe_div(2 * tn, 2 * tn + fn + fp))
    s0, s1 = tn + fp, tp + fn
    n = s0 + s1
    w0, w1 = _safe_div(s0, n), _safe_div(s1, n)
    rows = F.array(
        F.struct(F.lit("0").alias("class"), p0.alias("precision"), r0.alias("recall"),
                 f0.alias("f1"), s0.cast("bigint").alias("support")),
        F.struct(F.lit("1").alias("class"), p1.alias("precision"), r1.alias("recall"),
                 f1.alias("f1"), s1.cast("bigint").alias("support")),
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), _safe_div(tp + tn, n).alias("f1"),
                 n.cast("bigint").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), ((p0 + p1) / 2).alias("precision"),
                 ((r0 + r1) / 2).alias("recall"), ((f0 + f1) / 2).alias("f1"),
                 n.cast("bigint").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), (p0 * w0 + p1 * w1).alias("precision"),
                 (r0 * w0 + r1 * w1).alias("recall"), (f0 * w0 + f1 * w1).alias("f1"),
                 n.cast("bigint").alias("support")),
    )
    return cm.select(*by, F.inline(rows))


def score_bounds(scores: DataFrame, score: str, buckets: int) -> list[float]:
    """At most ``buckets - 1`` bounds that cut the distinct scores about evenly.
    They are fetched once, as numbers: a bucket is then the same for a score
    wherever and however often it is computed."""
    cuts = scores.approxQuantile(score, [i / buckets for i in range(1, buckets)], 1 / (4 * buckets))
    return sorted(set(cuts))


def bucket_of(score: Column, bounds: list[float]) -> Column:
    """How many bounds are at or below the score, by a balanced tree of tests."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(score < F.lit(bounds[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))
    return tree(0, len(bounds))


def score_table(df: DataFrame, score: str = "score", label: str = "label",
                buckets: int = BUCKETS) -> DataFrame:
    """Per distinct score: pos, neg and the counts strictly below it
    (pos_below, neg_below), plus totals P and N. Null scores are left out.

    The counts of each distinct score are written once: bounds, bucket totals and
    running counts read them, and the rows are scored and grouped one time only.
    A score's bucket depends on its value alone (``bucket_of``), so equal
    scores never split and repeated evaluations agree. Bucket totals get a
    prefix, and P and N, over a table of at most ``buckets`` rows (broadcast:
    a proven bound); each bucket orders only its own scores."""
    g = (df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias(score))
         .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")))
    g = materialize(g, "scores", codec="zstd")
    g = g.withColumn("_bk", bucket_of(F.col(score), score_bounds(g, score, buckets)))
    bt = g.groupBy("_bk").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    before = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bt = bt.select("_bk",
                   F.coalesce(F.sum("_bp").over(before), F.lit(0)).alias("_pb"),
                   F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_nb"),
                   F.sum("_bp").over(whole).alias("P"), F.sum("_bn").over(whole).alias("N"))
    within = Window.partitionBy("_bk").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    g = g.withColumns({"_pw": F.coalesce(F.sum("pos").over(within), F.lit(0)), "_nw": F.coalesce(F.sum("neg").over(within), F.lit(0))})
    return (g.join(F.broadcast(bt), "_bk")
            .select(score, "pos", "neg", (F.col("_pb") + F.col("_pw")).alias("pos_below"), (F.col("_nb") + F.col("_nw")).alias("neg_below"),
                    "P", "N"))


def areas(df: DataFrame, score: str = "score", label: str = "label", digits: int = 10) -> DataFrame:
    """One row ``auc_roc, auc_pr`` from one score table (see the two functions below)."""
    t = score_table(df, score, label)
    num = F.sum(_d("pos") * (_d("neg_below") + _d("neg") * 0.5))
    tp = _d("P") - _d("pos_below")
    fp = _d("N") - _d("neg_below")
    term = _d("pos") / _d("P") * (tp / (tp + fp))
    a = t.agg(num.alias("num"), F.sum(F.when(F.col("pos") > 0, term)).alias("ap"), F.first("P").alias("P"), F.first("N").alias("N"))
    return a.select(
        F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("num") / (_d("P") * _d("N"))).alias("auc_roc"),
        F.when(F.col("P") > 0, F.round(F.col("ap").cast(f"decimal(38,{digits + 6})"), digits).cast("double")).alias("auc_pr"))


def auc_roc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Area under ROC = P(score_pos > score_neg) + 1/2 P(tie); null if one
    class is missing."""
    return areas(df, score, label).select("auc_roc")


def average_precision(df: DataFrame, score: str = "score", label: str = "label",
                      digits: int = 10) -> DataFrame:
    """Σ (R_n − R_{n−1}) · P_n over distinct score thresholds (step-wise, not
    the trapezoid area), rounded to ``digits``."""
    return areas(df, score, label, digits).select("auc_pr")


def sweep_thresholds() -> list[tuple[int, str]]:
    """(i, decimal text of i/20) for i = 1..18: exact thresholds 0.05..0.90."""
    return [(i, f"{i / 20:.2f}") for i in range(1, S.SWEEP_STEPS + 1)]


def threshold_sweep(df: DataFrame, score: str = "score", label: str = "label", by: tuple[str, ...] = ()) -> DataFrame:
    """Counts and metrics at each sweep threshold from ONE aggregate (two
    conditional counts per threshold), unpivoted to one row per threshold (and
    value of ``by``)."""
    pos = F.col(label) == 1
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(pos).alias("P")]
    for i, t in sweep_thresholds():
        pred = F.col(score) >= F.expr(t)
        aggs += [F.count_if(pred).alias(f"pp{i}"), F.count_if(pred & pos).alias(f"tp{i}")]
    wide = df.groupBy(*by).agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(i / 20).alias("threshold"), F.col(f"pp{i}").alias("predicted_pos"),
                 F.col(f"tp{i}").alias("tp"))
        for i, _ in sweep_thresholds()])
    long = wide.select(*by, "n", "P", F.inline(rows))
    return long.select(
        *by, "threshold", "predicted_pos", "tp",
        (F.col("predicted_pos") - F.col("tp")).alias("fp"),
        (F.col("P") - F.col("tp")).alias("fn"),
        _safe_div("tp", "predicted_pos").alias("precision"),
        _safe_div("tp", "P").alias("recall"),
        _safe_div(2 * F.col("tp"), F.col("P") + F.col("predicted_pos")).alias("f1"),
        F.round((_safe_div("predicted_pos", "n") * 100).cast("decimal(38,12)"), 2)
        .cast("double").alias("flagged_pct"))


def best_threshold(sweep: DataFrame, default: float = 0.5) -> DataFrame:
    """Highest F1 among thresholds that flag something; the lowest threshold
    wins ties; ``default`` (F1 0) when no threshold has F1 > 0."""
    cand = sweep.where((F.col("predicted_pos") > 0) & (F.col("f1") > 0)).select(
        "threshold", "f1", F.lit(0).alias("_d"))
    fallback = sweep.sparkSession.range(1).select(
        F.lit(default).alias("threshold"), F.lit(0.0).alias("f1"), F.lit(1).alias("_d"))
    return (cand.unionByName(fallback)
            .orderBy(F.desc("f1"), "_d", "threshold").limit(1).drop("_d"))


def model_gate(auc: Column, recall: Column, min_auc: float = S.GATE_MIN_AUC,
               min_recall: float = S.GATE_MIN_RECALL, spark=None) -> DataFrame:
    """Gate rows (metric, value, minimum, passed)."""
    rows = F.array(
        F.struct(F.lit("auc_roc").alias("metric"), auc.alias("value"),
                 F.lit(min_auc).alias("minimum")),
        F.struct(F.lit("recall").alias("metric"), recall.alias("value"),
                 F.lit(min_recall).alias("minimum")))
    return (spark.range(1).select(F.inline(rows))
            .withColumn("passed", F.coalesce(F.col("value") >= F.col("minimum"), F.lit(False))))
