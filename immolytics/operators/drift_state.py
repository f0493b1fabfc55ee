"""Incremental data drift (M5): periods are compared from stored counts, their rows are read once.

The state holds exact counts per (period, column, value). Counts of batches add
up, so rows of a period may arrive in any number of batches, in any order. A new
period is compared with the old ones from the state alone: exactly the scores of
``drift.data_drift`` over the rows, without reading the reference again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import drift
from ..settings import DRIFT_THRESHOLD
from ..sources import commits

STATE = "period string, column_name string, number double, text string, n long"


def period_counts(rows: DataFrame, period: str | Column, numeric: list[str], categorical: list[str]) -> DataFrame:
    """The state of some rows, from one scan; nulls and NaN are not counted, rows without a period neither."""
    none, blank = F.lit(None).cast("double"), F.lit(None).cast("string")
    at = F.col(period) if isinstance(period, str) else period
    cells = [F.struct(F.lit(c).alias("column_name"), (F.nanvl(F.col(c).cast("double"), none) + F.lit(0.0)).alias("number"), blank.alias("text"))
             for c in numeric]
    cells += [F.struct(F.lit(c).alias("column_name"), none.alias("number"), F.col(c).cast("string").alias("text")) for c in categorical]
    long = rows.select(at.cast("string").alias("period"), F.inline(F.array(*cells)))
    return (long.where("period IS NOT NULL AND (number IS NOT NULL OR text IS NOT NULL)")
            .groupBy("period", "column_name", "number", "text").agg(F.count(F.lit(1)).alias("n")))


class DriftState:
    """Stored counts in a shared folder, a committed folder per batch (``sources.commits``)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _batches(self) -> list[str]:
        return [n for n in commits.names(self.spark, self.root) if n.startswith("batch-")]

    def add(self, batch: str, rows: DataFrame, period: str | Column, numeric: list[str], categorical: list[str]) -> bool:
        """Count a batch and store it; false, and nothing stored, if the batch is there already (a repeated job)."""
        final = f"{self.root}/batch-{batch}"
        held = commits.manifest(self.spark, final) is not None
        counts = period_counts(rows, period, numeric, categorical)
        return not held and commits.commit(self.spark, commits.stage(counts, final), final)

    def counts(self) -> DataFrame:
        """The state of all batches, a row per period, column and value."""
        paths = [f"{self.root}/{b}" for b in self._batches()]
        rows = self.spark.read.schema(STATE).parquet(*paths) if paths else self.spark.createDataFrame([], STATE)
        return rows.groupBy("period", "column_name", "number", "text").agg(F.sum("n").alias("n"))

    def drift(self, reference: Column, current: Column, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
        """M5 report of the periods where ``current`` holds against those where ``reference`` does (conditions on ``period``)."""
        chosen = self.counts().where(reference | current)
        counts = chosen.groupBy("column_name", "number", "text").agg(
            F.bool_or(F.col("number").isNotNull()).alias("numeric"),
            F.coalesce(F.sum(F.when(reference, F.col("n"))), F.lit(0)).alias("n_ref"),
            F.coalesce(F.sum(F.when(current, F.col("n"))), F.lit(0)).alias("n_cur"))
        return drift.report_of(counts, threshold=threshold)
