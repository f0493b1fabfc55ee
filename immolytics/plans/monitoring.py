"""Monitoring flows: data drift against a write-once reference, model drift on two halves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import drift, metrics, splits
from ..session import materialize
from ..settings import DRIFT_THRESHOLD, MODEL_DRIFT_THRESHOLD
from ..sources.runlog import RunLog
from ..sources.snapshot import reference_and_current


def check_data_drift(spark: SparkSession, current: DataFrame, reference_path: str, key_columns: list[str],
                     numeric: list[str], categorical: list[str], threshold: float = DRIFT_THRESHOLD,
                     runlog: RunLog | None = None, gate: bool = True) -> tuple[DataFrame, DataFrame]:
    """S8 + M5 + M6 (+ S9): report per column, one-row summary; raises when the gate says stop."""
    ref, cur = reference_and_current(spark, current, reference_path, key_columns)
    # A row per column, written once for the log, the gate and the caller.
    report = materialize(drift.data_drift(ref, cur, numeric, categorical, threshold), "drift-report")
    summary = drift.dataset_drift(report)
    if runlog is not None:
        run_id = runlog.start_run("data_drift_check", tags={"Run_Type": "data_drift"},
                                  params={"drift_threshold": threshold})
        runlog.log_metrics_frame(run_id, report, "column_name", "score")
    if gate:
        drift.drift_gate(summary)
    return report, summary


def check_model_drift(scored_test: DataFrame, key_columns: list[str], threshold: float = MODEL_DRIFT_THRESHOLD,
                      label: str = "prix", runlog: RunLog | None = None) -> DataFrame:
    """M7 + M8 (+ S9): first half of the scored test rows (by key) vs the second half."""
    halves = splits.positional_halves(scored_test, key_columns)
    report = materialize(metrics.model_drift(halves, label=label, threshold=threshold), "model-drift-report")
    if runlog is not None:
        run_id = runlog.start_run("model_drift_check", tags={"Run_Type": "model_drift"})
        runlog.log_metrics_frame(run_id, report, "metric", "relative_diff")
    return report
