"""Regression metrics and error analysis.

All metrics are plain aggregates of sums, so they combine map-side and can be
grouped by any column (split, category, half) in the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..settings import MODEL_DRIFT_THRESHOLD
from .quantiles import quantile_columns

METRICS = ["mse", "rmse", "mae", "r2"]


def residual(label: str = "prix", prediction: str = "prediction") -> Column:
    return F.col(label) - F.col(prediction)


def regression_metrics(df: DataFrame, label: str = "prix", prediction: str = "prediction",
                       by: list[str] = (), **more: Column) -> DataFrame:
    """N, MSE, RMSE, MAE and R2 = 1 - SSE / SST (not the squared correlation); ``more`` in the same pass."""
    e = residual(label, prediction)
    agg = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(e * e).alias("mse"),
        F.avg(F.abs(e)).alias("mae"),
        F.sum(e * e).alias("_sse"),
        (F.var_pop(label) * F.count(F.lit(1))).alias("_sst"), *[c.alias(k) for k, c in more.items()])
    return agg.select(*by, "n", "mse", F.sqrt("mse").alias("rmse"), "mae",
                      (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_sst"))).alias("r2"), *more)


def abs_error_stats(df: DataFrame, label: str = "prix", prediction: str = "prediction",
                    by: list[str] = (), exact: bool = True) -> DataFrame:
    """describe() of |error|: count, mean, std (ddof 1), min, quartiles, max."""
    a = F.abs(residual(label, prediction))
    moments = [F.count(F.lit(1)).alias("count"), F.avg(a).alias("mean"), F.stddev_samp(a).alias("std"),
               F.min(a).alias("min"), F.max(a).alias("max")]
    names = ["p25", "p50", "p75"]
    if exact:
        base = df.select(*by, a.alias("_a"))
        q = quantile_columns(base, "_a", [0.25, 0.5, 0.75], names, list(by))
        out = df.groupBy(*by).agg(*moments)
        out = out.join(q, list(by), "left") if by else _attach(out, q)
    else:
        out = df.groupBy(*by).agg(*moments, F.percentile_approx(a, [0.25, 0.5, 0.75], 10_000)
                                  .cast("array<double>").alias("_q"))
        out = out.select("*", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)]).drop("_q")
    return out.select(*by, "count", "mean", "std", "min", *names, "max")


def residual_range(df: DataFrame, label: str = "prix", prediction: str = "prediction",
                   k: float = 4.0) -> DataFrame:
    """Display bounds mean +/- k population std of the residuals."""
    e = residual(label, prediction)
    s = df.agg(F.avg(e).alias("mean"), F.stddev_pop(e).alias("std"))
    return s.select("mean", "std", (F.col("mean") - k * F.col("std")).alias("low"),
                    (F.col("mean") + k * F.col("std")).alias("high"))


def extreme_errors(df: DataFrame, key: str, columns: list[str], label: str = "prix",
                   prediction: str = "prediction") -> DataFrame:
    """The whole rows with the largest and the smallest residual (ties by key)."""
    row = F.struct(*[F.col(c) for c in [key, *columns]])
    e = residual(label, prediction)
    one = df.agg(F.max_by(row, F.struct(e, F.col(key))).alias("largest"),
                 F.min_by(row, F.struct(e, F.col(key))).alias("smallest"))
    return one.select(F.inline(F.array(
        F.struct(F.lit("largest").alias("which"), F.col("largest.*")),
        F.struct(F.lit("smallest").alias("which"), F.col("smallest.*")))))


def error_by_category(df: DataFrame, categories: list[str], label: str = "prix",
                      prediction: str = "prediction") -> DataFrame:
    """Residual distribution and metrics per category value, for several category columns at once."""
    e = residual(label, prediction)
    base = df.select(e.alias("_e"), F.col(label).alias("_y"), F.col(prediction).alias("_p"),
                     *[F.col(c).cast("string").alias(c) for c in categories])
    lv = base.unpivot(["_e", "_y", "_p"], categories, "category_column", "category")
    keys = ["category_column", "category"]
    out = lv.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg("_e").alias("mean_error"),
        F.avg(F.abs("_e")).alias("mae"), F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(F.col("_e") * F.col("_e")),
                                   F.var_pop("_y") * F.count(F.lit(1)))).alias("r2"))
    q = quantile_columns(lv, "_e", [0.25, 0.5, 0.75], ["q1", "median", "q3"], keys)
    return (out.join(q, keys, "left")
               .select(*keys, "n", "mean_error", "mae", "rmse", "r2", "q1", "median", "q3"))


def with_mean_baseline(train: DataFrame, df: DataFrame, label: str = "prix",
                       prediction: str = "prediction") -> DataFrame:
    """Constant predictor = mean of the training label (a scalar subquery)."""
    return df.withColumn(prediction, train.select(F.avg(label)).scalar())


def evaluate(scored: DataFrame, label: str = "prix", prediction: str = "prediction",
             split: str = "split") -> DataFrame:
    """M4: metrics and |error| statistics for every split, one row each."""
    a = F.abs(residual(label, prediction))
    return regression_metrics(scored, label, prediction, [split],
                              error_mean=F.avg(a), error_std=F.stddev_samp(a))


def _attach(one_row: DataFrame, q: DataFrame) -> DataFrame:
    """Join two one-row frames (no keys) through a constant key."""
    return one_row.withColumn("_one", F.lit(1)).join(q.withColumn("_one", F.lit(1)), "_one").drop("_one")


def relative_diff(ref: Column, cur: Column) -> Column:
    """|cur - ref| / |ref|, or |cur - ref| when ref = 0."""
    d = F.abs(cur - ref)
    return F.when(ref != 0, d / F.abs(ref)).otherwise(d)


def model_drift(scored: DataFrame, dataset: str = "dataset", label: str = "prix",
                prediction: str = "prediction", threshold: float = MODEL_DRIFT_THRESHOLD) -> DataFrame:
    """M7/M8: metrics on reference vs current rows; relative change above ``threshold`` is drift."""
    m = regression_metrics(scored, label, prediction, [dataset]).drop("n")
    long = m.unpivot([dataset], METRICS, "metric", "value")
    wide = long.groupBy("metric").agg(
        F.max(F.when(F.col(dataset) == "reference", F.col("value"))).alias("reference_value"),
        F.max(F.when(F.col(dataset) == "current", F.col("value"))).alias("current_value"))
    rd = relative_diff(F.col("reference_value"), F.col("current_value"))
    return wide.select("metric", "reference_value", "current_value", rd.alias("relative_diff"),
                       (rd > threshold).alias("has_drift"))


def drift_table(report: DataFrame) -> DataFrame:
    """M8: Metric, Reference, Current, Drift (%)."""
    return report.select(F.col("metric").alias("Metric"), F.col("reference_value").alias("Reference"),
                         F.col("current_value").alias("Current"),
                         (F.col("relative_diff") * 100).alias("Drift (%)"))
