"""Model dataflow: time split, class weights, boosted trees, scoring.

Training and scoring run on executors (Spark ML); nothing is collected."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txwatch import schemas as S
from txwatch.functions import columns as C


def split_label(ts: str = "timestamp", train_end: str = S.TRAIN_END,
                val_end: str = S.VAL_END) -> F.Column:
    t = F.col(ts)
    te = F.lit(train_end).cast("timestamp_ntz")
    ve = F.lit(val_end).cast("timestamp_ntz")
    return F.when(t <= te, "train").when(t <= ve, "val").otherwise("test")


def ml_dataset(gold: DataFrame, train_end: str = S.TRAIN_END, val_end: str = S.VAL_END,
               keep_id: bool = True) -> DataFrame:
    """Features + label + split; the timestamp is dropped after the split."""
    cols = (["transaction_id"] if keep_id else []) + list(S.FEATURES) + [S.TARGET]
    return gold.select(*cols, split_label("timestamp", train_end, val_end).alias("split"))


def class_balance(ds: DataFrame) -> DataFrame:
    """pos, neg on the train split; scale_pos_weight = round(neg/pos, 2), or
    1000 when there is no positive."""
    tr = ds.where(F.col("split") == "train")
    b = tr.agg(F.count_if(F.col(S.TARGET) == 1).alias("pos"),
               F.count_if(F.col(S.TARGET) == 0).alias("neg"))
    spw = F.when(F.col("pos") > 0,
                 C.round_half_up(F.col("neg").cast("double") / F.col("pos").cast("double"), 2)
                 ).otherwise(F.lit(1000.0))
    return b.withColumn("scale_pos_weight", spw)


def gbt_pipeline(max_iter: int = 500, seed: int = 42) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(S.FEATURES), outputCol="features",
                                handleInvalid="keep")
    gbt = GBTClassifier(
        labelCol=S.TARGET, featuresCol="features", weightCol="_w",
        maxDepth=6, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.8",
        minInstancesPerNode=5, maxIter=max_iter, seed=seed,
        validationIndicatorCol="_is_val", validationTol=0.01, maxBins=64)
    return Pipeline(stages=[assembler, gbt])


def train(ds: DataFrame, max_iter: int = 500, seed: int = 42) -> PipelineModel:
    """Fit on train with val as the early-stopping set; positives weighted by
    scale_pos_weight (a scalar subquery, no driver round trip)."""
    spw = class_balance(ds).select("scale_pos_weight").scalar()
    fit_df = (ds.where(F.col("split").isin("train", "val"))
              .withColumn(S.TARGET, F.col(S.TARGET).cast("double"))
              .withColumn("_w", F.when(F.col(S.TARGET) == 1, spw).otherwise(F.lit(1.0)))
              .withColumn("_is_val", F.col("split") == "val"))
    return gbt_pipeline(max_iter, seed).fit(fit_df)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """transaction_id, ml_probability, final_risk_score (equal)."""
    out = model.transform(df)
    p = vector_to_array(F.col("probability"))[1]
    return out.select("transaction_id", p.alias("ml_probability"), p.alias("final_risk_score"))


def feature_importance(model: PipelineModel) -> DataFrame:
    """Per-feature split importance of the fitted trees (15 rows)."""
    gbt = model.stages[-1]
    spark = SparkSession.getActiveSession()
    imp = gbt.featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(S.FEATURES, imp)]
    return (spark.createDataFrame(rows, "feature string, importance double")
            .orderBy(F.desc("importance"), "feature"))


def save_model(model: PipelineModel, root: str, version: str, metrics: DataFrame) -> str:
    """Registry entry: the model folder plus one metadata row per version."""
    path = f"{root.rstrip('/')}/models/{version}"
    model.write().overwrite().save(path)
    (metrics.withColumn("version", F.lit(version)).withColumn("path", F.lit(path))
     .write.mode("append").parquet(f"{root.rstrip('/')}/registry"))
    return path


def latest_model(spark, root: str) -> tuple[PipelineModel, DataFrame]:
    reg = spark.read.parquet(f"{root.rstrip('/')}/registry")
    row = reg.orderBy(F.desc("version")).limit(1)
    path = row.select("path").first()[0]
    return PipelineModel.load(path), row


def permuted_features(ds: DataFrame, seed: int = 42, bucket_rows: int = 1_000_000,
                      id_col: str = "transaction_id") -> DataFrame:
    """Each row gets the feature vector of another row (``_p_<feature>``).

    Rows fall into random buckets of about ``bucket_rows`` rows (the bucket
    count comes from one count); inside a bucket two independent hash orders
    number the rows, and joining the two numberings pairs every row with a
    random row of its bucket. No global ordering, and no bucket grows with
    the data."""
    n = ds.count()
    buckets = max(1, -(-n // bucket_rows))
    b = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(buckets))
    keyed = ds.withColumn("_b", b)
    w_row = Window.partitionBy("_b").orderBy(F.xxhash64(F.col(id_col), F.lit(seed + 1)), id_col)
    w_val = Window.partitionBy("_b").orderBy(F.xxhash64(F.col(id_col), F.lit(seed + 2)), id_col)
    rows = keyed.withColumn("_rn", F.row_number().over(w_row))
    vals = keyed.select("_b", F.row_number().over(w_val).alias("_rn"),
                        *[F.col(f).alias(f"_p_{f}") for f in S.FEATURES])
    return rows.join(vals, ["_b", "_rn"]).drop("_b", "_rn")


def permutation_importance(model: PipelineModel, ds: DataFrame, seed: int = 42) -> DataFrame:
    """AUC drop when one feature takes another row's value, on the val and
    test rows. The permuted frame is written once (lineage cut), then each
    feature costs one scoring pass whose AUC is a distributed aggregate; one
    number per feature reaches the driver."""
    from txwatch.operators.metrics import auc_roc
    from txwatch.session import materialize, settings, shuffles_for
    spark = ds.sparkSession
    held = ds.where(F.col("split") != "train")
    # both numberings lie by bucket already: joining them moves nothing more
    with shuffles_for(spark, held.count()), settings(spark, spark_sql_requireAllClusterKeysForCoPartition="false"):
        perm = materialize(permuted_features(held, seed), "permuted", codec="zstd")

    def auc_of(frame: DataFrame) -> float | None:
        ev = model.transform(frame).select(
            vector_to_array(F.col("probability"))[1].alias("score"),
            F.col(S.TARGET).alias("label"))
        return auc_roc(ev).first()[0]

    base = auc_of(perm)
    rows = []
    for f in S.FEATURES:
        a = auc_of(perm.withColumn(f, F.col(f"_p_{f}")))
        rows.append((f, base, a, None if base is None or a is None else base - a))
    return (spark.createDataFrame(rows, "feature string, base_auc double, permuted_auc double, "
                                        "auc_drop double")
            .orderBy(F.desc("auc_drop"), "feature"))


def evaluate(model: PipelineModel, ds: DataFrame) -> DataFrame:
    """Val and test metrics of a fitted model: the decision threshold is the
    best-F1 sweep threshold on val (applied to both splits); AUC, average
    precision, confusion counts and precision/recall/F1 per split."""
    from txwatch.operators import metrics as M
    from txwatch.session import materialize
    scored = model.transform(ds.where(F.col("split") != "train")).select(
        "split", vector_to_array(F.col("probability"))[1].alias("score"),
        F.col(S.TARGET).alias("label"))
    scored = materialize(scored, "scored", codec="zstd")  # the trees score each row once
    val = scored.where(F.col("split") == "val")
    # one number, fetched: all reports then use the same one
    thr = F.lit(M.best_threshold(M.threshold_sweep(val)).first()["threshold"])
    out = []
    for split in ("val", "test"):
        part = scored.where(F.col("split") == split)
        auc, precision = M.areas(part).first()
        row = (M.from_confusion(M.confusion(part, thr))
               .withColumn("auc_roc", F.lit(auc).cast("double"))
               .withColumn("auc_pr", F.lit(precision).cast("double"))
               .withColumn("threshold", thr)
               .withColumn("split", F.lit(split)))
        out.append(row)
    return out[0].unionByName(out[1])
