import pytest
from pyspark.sql import functions as F

from immolytics.plans import queries as Q
from immolytics.plans.monitoring import check_data_drift, check_model_drift
from immolytics.plans.training import error_analysis, train_and_log_model
from immolytics.sources.runlog import RunLog, latest_run, require_run

from .conftest import SF, SF_SMALL


def test_training_flow_and_model_drift(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "runs"))
    prepared = Q.prepared_table(spark, SF_SMALL)
    out = train_and_log_model(prepared, ["annee_transaction", "mois_transaction", "id_transaction"], log,
                              n_splits=3, maxIter=3, maxDepth=3)
    assert out["cv"].count() == 3
    assert require_run(latest_run(log.table("runs"), log.table("tags")))
    parent = require_run(latest_run(log.table("runs"), log.table("tags")))
    found = error_analysis(out["model"], out["train"], out["test"], runlog=log, parent_id=parent)
    ev = {r["split"]: r for r in found.collect()}
    assert set(ev) == {"train", "test"}
    run = log.table("runs").where("run_name = 'model_evaluation'").first()
    assert run["parent_run_id"] == parent
    logged = {r["key"]: r["value"] for r in log.table("metrics").where(F.col("run_id") == run["run_id"]).collect()}
    assert logged == {f"{s.capitalize()}{name}": pytest.approx(ev[s][column]) for s in ("train", "test") for name, column in
                      ((" RMSE", "rmse"), (" MAE", "mae"), (" R2", "r2"), ("_Error_Mean", "error_mean"), ("_Error_Std", "error_std"))}
    from immolytics.operators import model as pm
    rep = check_model_drift(pm.score(out["model"], out["test"]), ["id_transaction"], runlog=log)
    assert {r["metric"] for r in rep.collect()} == {"mse", "rmse", "mae", "r2"}


def test_data_drift_flow_gate(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    path = str(tmp_path / "ref.parquet")
    report, summary = check_data_drift(spark, ev, path, ["event_id"], ["value"], ["event_type"],
                                       runlog=RunLog(spark, str(tmp_path / "runs")))
    assert report.count() == 2 and summary.first()["total_features"] == 2
    shifted = ev.withColumn("value", F.col("value") * 10).withColumn("event_type", F.lit("x"))
    with pytest.raises(RuntimeError):
        check_data_drift(spark, shifted, path, ["event_id"], ["value"], ["event_type"])


def test_binding_prunes_columns(spark):
    plan = Q.transactions(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "o_totalprice" not in plan and "c_acctbal" not in plan
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan
