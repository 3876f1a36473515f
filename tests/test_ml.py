"""Model training, registry, batch and stream scoring on sf0.001."""
import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF001
from txwatch import schemas as S
from txwatch.operators import metrics as M
from txwatch.operators import ml as ML
from txwatch.plans import publish as P
from txwatch.plans.pipeline import Ledger
from txwatch.streaming import streams as SS


def test_train_score_registry_and_stream(spark):
    lg = Ledger(spark, SF001, persist=False)
    ds = ML.ml_dataset(lg.gold)
    model = ML.train(ds, max_iter=5)
    scores = ML.score(model, ds)
    assert scores.count() == lg.gold.count()
    assert scores.where((F.col("ml_probability") < 0) | (F.col("ml_probability") > 1)).count() == 0
    imp = ML.feature_importance(model).collect()
    assert len(imp) == len(S.FEATURES) and abs(sum(r.importance for r in imp) - 1.0) < 1e-9

    root = tempfile.mkdtemp(prefix="txw-ml-")
    P.write_splits(ds, f"{root}/splits")
    assert {r.split for r in spark.read.parquet(f"{root}/splits").select("split").distinct().collect()} \
        <= {"train", "val", "test"}
    P.write_scores(scores, f"{root}/scores")
    ev = scores.join(ds.select("transaction_id", S.TARGET), "transaction_id").select(
        F.col("ml_probability").alias("score"), F.col(S.TARGET).alias("label"))
    metrics = M.auc_roc(ev).withColumn("threshold", F.lit(0.9))
    ML.save_model(model, root, "v0001", metrics)
    ML.save_model(model, root, "v0002", metrics)
    loaded, row = ML.latest_model(spark, root)
    assert row.first().version == "v0002"

    # the same fitted pipeline scores a stream of gold rows
    gold_dir = f"{root}/gold_stream"
    ds.write.parquet(gold_dir)
    stream = spark.readStream.schema(ds.schema).parquet(gold_dir)
    out = SS.run_available(SS.stream_scores(spark, stream, loaded), spark, "scores")
    batch = {r.transaction_id: r.ml_probability for r in ML.score(loaded, ds).collect()}
    got = {r.transaction_id: r.ml_probability for r in out.collect()}
    assert got.keys() == batch.keys()
    assert all(abs(got[k] - batch[k]) < 1e-12 for k in got)


def test_permutation_is_a_bucketed_permutation(spark):
    lg = Ledger(spark, SF001, persist=False)
    ds = ML.ml_dataset(lg.gold)
    perm = ML.permuted_features(ds, bucket_rows=200)
    assert perm.count() == ds.count()
    # every feature value multiset is preserved (a permutation, not a sample)
    for f in ("amount", "rule_score"):
        a = sorted(r[0] for r in ds.select(f).collect())
        b = sorted(r[0] for r in perm.select(f"_p_{f}").collect())
        assert a == b
    moved = perm.where(F.col("amount") != F.col("_p_amount")).count()
    assert moved > ds.count() // 2
