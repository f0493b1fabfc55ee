import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler

from immolytics.operators import metrics
from immolytics.plans.training import error_analysis


@pytest.fixture
def linear(spark):
    rng = np.random.default_rng(42)

    def frame(n):
        x1, x2 = rng.normal(size=n), rng.normal(size=n)
        return pd.DataFrame({"feature1": x1, "feature2": x2, "prix": 2 * x1 + x2 + rng.normal(0, 0.1, n)})
    tr, te = spark.createDataFrame(frame(100)), spark.createDataFrame(frame(30))
    model = Pipeline(stages=[VectorAssembler(inputCols=["feature1", "feature2"], outputCol="features"),
                             LinearRegression(featuresCol="features", labelCol="prix")]).fit(tr)
    return model, tr, te


def test_error_analysis_metrics(linear):
    model, tr, te = linear
    out = {r["split"]: r for r in error_analysis(model, tr, te).collect()}
    for s in ("train", "test"):
        r = out[s]
        for k in ("rmse", "mae", "r2", "mse", "error_mean", "error_std"):
            assert isinstance(r[k], float)
        assert 0 <= r["r2"] <= 1 and r["rmse"] > 0 and r["mae"] > 0


def test_empty_inputs_raise(linear):
    model, tr, te = linear
    with pytest.raises(ValueError):
        error_analysis(model, tr.limit(0), te)


def test_metrics_against_numpy(spark):
    rng = np.random.default_rng(1)
    y, p = rng.normal(100, 10, 500), rng.normal(100, 10, 500)
    df = spark.createDataFrame(pd.DataFrame({"prix": y, "prediction": p}))
    r = metrics.regression_metrics(df).first()
    assert r["mse"] == pytest.approx(np.mean((y - p) ** 2))
    assert r["mae"] == pytest.approx(np.mean(np.abs(y - p)))
    assert r["r2"] == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))
    a = metrics.abs_error_stats(df).first()
    e = np.abs(y - p)
    assert a["std"] == pytest.approx(np.std(e, ddof=1))
    assert a["p25"] == pytest.approx(np.percentile(e, 25))
    rr = metrics.residual_range(df).first()
    assert rr["high"] == pytest.approx(np.mean(y - p) + 4 * np.std(y - p))


def test_model_drift_relative_diff(spark):
    rows = [("reference", 10.0, 11.0), ("reference", 20.0, 19.0), ("current", 10.0, 14.0), ("current", 20.0, 16.0)]
    df = spark.createDataFrame(rows, "dataset string, prix double, prediction double")
    rep = {r["metric"]: r for r in metrics.model_drift(df).collect()}
    assert rep["mae"]["reference_value"] == pytest.approx(1.0)
    assert rep["mae"]["current_value"] == pytest.approx(4.0)
    assert rep["mae"]["relative_diff"] == pytest.approx(3.0) and rep["mae"]["has_drift"]
