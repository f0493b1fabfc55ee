import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from immolytics.operators import model as pm, splits
from immolytics.sources.runlog import RunLog, latest_parent_run, latest_run, require_run


def test_cross_validation_keys(spark):
    rng = np.random.default_rng(42)
    pdf = pd.DataFrame(rng.uniform(size=(100, 5)), columns=[f"feature_{i}" for i in range(5)])
    pdf["target"] = rng.uniform(size=100)
    pdf["t"] = range(100)
    df = spark.createDataFrame(pdf)
    feats = [f"feature_{i}" for i in range(5)]
    blocks = splits.time_series_blocks(df, ["t"], 3)
    sizes = {r["block"]: r["count"] for r in blocks.groupBy("block").count().collect()}
    assert sizes == {0: 25, 1: 25, 2: 25, 3: 25}          # n // (k + 1) = 25 per test block
    cv = pm.cross_validate(blocks, pm.gbt_fitter(feats, "target", maxIter=3, maxDepth=2), 3, label="target")
    d = pm.cv_scores_dict(cv)
    for m in ("neg_root_mean_squared_error", "neg_mean_absolute_error", "r2"):
        for k in ("moyenne_test", "moyenne_train", "ecart_type_test", "ecart_type_train"):
            assert f"{k}_{m}" in d
    model = pm.train_price_model(df, feats, "target", maxIter=3, maxDepth=2)
    assert pm.score(model, df).where(F.col("prediction").isNull()).count() == 0


def test_folds_fitted_in_parallel_give_the_same_scores(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.uniform(size=200), "t": range(200)})
    pdf["prix"] = 3 * pdf.a + rng.normal(0, 0.1, 200)
    blocks = splits.time_series_blocks(spark.createDataFrame(pdf), ["t"], 4).cache()
    fit = pm.gbt_fitter(["a"], maxIter=3, maxDepth=2)
    one, four = (sorted(map(tuple, pm.fold_metrics(blocks, fit, 4, parallelism=p).collect())) for p in (1, 4))
    assert len(one) == 8 and np.allclose([r[2:] for r in one], [r[2:] for r in four])
    assert [r[:2] for r in one] == [r[:2] for r in four]
    mean = {r.fold: r.rmse for r in pm.fold_metrics(blocks, pm.mean_fitter(), 4).where("role = 'test'").collect()}
    assert all(rmse < 0.5 * mean[fold] for fold, role, _, _, rmse, *_ in one if role == "test")


def test_gbt_beats_mean_baseline(spark):
    rng = np.random.default_rng(7)
    n = 400
    x = rng.uniform(0, 10, size=(n, 2))
    pdf = pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "prix": 3 * x[:, 0] + x[:, 1] ** 2 + rng.normal(0, 0.5, n)})
    df = spark.createDataFrame(pdf)
    model = pm.train_price_model(df, ["a", "b"], maxIter=20, maxDepth=3)
    mse_gbt = pm.score(model, df).select(F.avg((F.col("prix") - F.col("prediction")) ** 2)).first()[0]
    assert mse_gbt < 0.2 * pdf["prix"].var()


def test_run_log_latest(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "runs"))
    a = log.start_run("exploration", tags={"Run_Type": "eda"})
    b = log.start_run("training_v1", tags={"Run_Type": "model_training"}, params={"maxIter": 150})
    log.log_metrics(b, {"rmse": 1.0})
    log.start_run("child", parent_id=b)
    got = require_run(latest_run(log.table("runs"), log.table("tags")))
    assert got == b and got != a
    c = log.start_run("training_untagged")                    # newer, but not tagged: only the name finds it
    assert require_run(latest_run(log.table("runs"), log.table("tags"))) == b
    assert require_run(latest_parent_run(log.table("runs"))) == c


def test_integer_folds_and_groups(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"a": rng.uniform(size=90), "g": [i % 9 for i in range(90)], "t": range(90)})
    pdf["prix"] = 5 * pdf.a
    df = spark.createDataFrame(pdf)
    for folded in (splits.k_folds(df, ["t"], 3), splits.group_folds(df, ["g"], 3)):
        cv = pm.cross_validate(folded, pm.mean_fitter(), 3, kind="k")
        got = pm.cv_scores_dict(cv)
        p = folded.toPandas()
        parts = [(p[p.fold != i].prix, p[p.fold == i].prix) for i in range(3)]
        want = [-np.sqrt(((test - train.mean()) ** 2).mean()) for train, test in parts]
        assert abs(got["moyenne_test_neg_root_mean_squared_error"] - np.mean(want)) < 1e-9
        assert abs(got["ecart_type_test_neg_root_mean_squared_error"] - np.std(want)) < 1e-9


def test_kfold_cross_validator(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.uniform(size=120), "b": rng.uniform(size=120), "t": range(120)})
    pdf["prix"] = 2 * pdf.a + pdf.b
    df = splits.k_folds(spark.createDataFrame(pdf), ["t"], 3)
    cv = pm.kfold_cross_validator(["a", "b"], 3, maxIter=3, maxDepth=2).fit(df)
    assert len(cv.avgMetrics) == 1 and cv.avgMetrics[0] > 0
