"""Price model on Spark ML.

``VectorAssembler`` + ``GBTRegressor`` in one ``Pipeline`` (beyond 500,000 training
rows its trees are fitted by ``boosting``); scoring is
``PipelineModel.transform`` for one row or a billion. Cross-validation fits one
model per fold and scores all folds in a single metrics job.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, functions as F

from ..functions.text import normalize_text
from ..settings import GBT_PARAMS, REGRESSION_TARGET
from . import boosting
from .columns import align_columns
from .encode import OneHotModel, indicator
from .metrics import regression_metrics
from .tree_attribution import tree_nodes

Scorer = Callable[[DataFrame], DataFrame]
# Training rows that a task of the booster holds.
ROWS_IN_PART = 500_000


def price_pipeline(features: list[str], label: str = REGRESSION_TARGET, **overrides) -> Pipeline:
    """M1: features -> vector -> gradient-boosted trees (reference hyper-parameters by default)."""
    params = {**GBT_PARAMS, **overrides}
    return Pipeline(stages=[
        VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"),
        GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction", **params),
    ])


def in_even_parts(train: DataFrame, rows: int | None = None) -> DataFrame:
    """``train`` dealt into parts of about ``rows`` rows (unchanged if it has no more than that in all).

    The booster keeps its rows as objects, many times the size of their files: parts as large as
    files allow would be too much for one task, and uneven.
    """
    rows = rows or ROWS_IN_PART
    n = train.count()
    if n <= rows:
        return train
    parts = max(math.ceil(n / rows), train.sparkSession.sparkContext.defaultParallelism)
    return train.repartition(parts, *[F.col(f"`{c}`") for c in train.columns], F.spark_partition_id())     # equal rows are spread too


def train_price_model(train: DataFrame, features: list[str], label: str = REGRESSION_TARGET,
                      **overrides) -> PipelineModel:
    """The fitted pipeline; ``many_rows`` is set on it if its trees are fitted by ``boosting``."""
    named = [v for v in overrides.values() if isinstance(v, str) and v in train.columns]               # weightCol and the like
    needed = train.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*features, label, *named])])
    pipeline, even = price_pipeline(features, label, **overrides), in_even_parts(needed)
    if even is needed or not boosting.supports(needed, features, {**GBT_PARAMS, **overrides}):
        return pipeline.fit(even)
    assembler, gbt = pipeline.getStages()
    model = PipelineModel([assembler, boosting.fit(gbt, needed, features)])
    model.many_rows = True
    return model


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M3: batch prediction (drops the assembled vector); a model just fitted to many rows scores a batch of rows at a time."""
    if getattr(model, "many_rows", False):
        return df.withColumn("prediction", boosting.prediction(tree_nodes(df.sparkSession, model), model.stages[0].getInputCols()))
    return model.transform(df).drop("features")


def save_model(model: PipelineModel, path: str) -> None:
    """S11."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def gbt_fitter(features: list[str], label: str = REGRESSION_TARGET, **overrides) -> Callable[[DataFrame], Scorer]:
    """``score`` after ``train_price_model``; trees over many rows also score a batch of rows at a time."""
    def fit(train: DataFrame) -> Scorer:
        m = train_price_model(train, features, label, **overrides)
        if not getattr(m, "many_rows", False):
            return lambda df: score(m, df)
        total = boosting.prediction(tree_nodes(train.sparkSession, m), features)
        return lambda df: df.withColumn("prediction", total)
    return fit


def mean_fitter(label: str = REGRESSION_TARGET) -> Callable[[DataFrame], Scorer]:
    """A23 as an estimator: predicts the training mean (a scalar subquery)."""
    def fit(train: DataFrame) -> Scorer:
        mean = train.select(F.avg(label)).scalar()
        return lambda df: df.withColumn("prediction", mean)
    return fit


CV_METRICS = {"neg_root_mean_squared_error": ("rmse", -1.0),
              "neg_mean_absolute_error": ("mae", -1.0),
              "r2": ("r2", 1.0)}


def fold_metrics(df: DataFrame, fit: Callable[[DataFrame], Scorer], n_splits: int, kind: str = "expanding",
                 block: str | None = None, label: str = REGRESSION_TARGET, parallelism: int = 1) -> DataFrame:
    """Metrics per (fold, role) of ``cross_validate``; ``parallelism`` folds are fitted at a time."""
    if kind not in ("expanding", "k"):
        raise ValueError(f"unknown kind of folds: {kind}")
    at = F.col(block or ("block" if kind == "expanding" else "fold"))
    numbers = range(1, n_splits + 1) if kind == "expanding" else range(n_splits)
    parts = [(at == i, at < i if kind == "expanding" else at != i) for i in numbers]
    with ThreadPool(max(1, parallelism)) as pool:
        scorers = pool.map(inheritable_thread_target(df.sparkSession)(lambda part: fit(df.where(part[1]))), parts)
    scored, roles = df, []
    for i, scorer, (is_test, is_train) in zip(numbers, scorers, parts):
        scored = scorer(scored).withColumnRenamed("prediction", f"_p{i}")
        role = F.when(is_test, "test").when(is_train, "train")
        roles.append(F.struct(F.lit(i).alias("fold"), role.alias("role"), F.col(f"_p{i}").alias("prediction")))
    long = scored.select(F.col(label).alias(label), F.inline(F.array(*roles))).where(F.col("role").isNotNull())
    return regression_metrics(long, label, "prediction", ["fold", "role"])


def cross_validate(df: DataFrame, fit: Callable[[DataFrame], Scorer], n_splits: int, kind: str = "expanding",
                   block: str | None = None, label: str = REGRESSION_TARGET, parallelism: int = 1) -> DataFrame:
    """M2: per metric, mean and population std over folds, for train and test scores.

    ``kind`` "expanding": ``block`` holds expanding-window blocks
    (``splits.time_series_blocks``), fold i trains on the blocks before i. "k":
    ``block`` holds fold numbers 0..n_splits-1 (``splits.k_folds`` for an integer
    number of folds, ``splits.group_folds`` for groups), fold i trains on all
    others. One fit per fold; then one scan of ``df`` carries the predictions of
    all folds, and one aggregate gives all scores. One row per metric:
    ``moyenne_train, ecart_type_train, moyenne_test, ecart_type_test``.
    """
    m = fold_metrics(df, fit, n_splits, kind, block, label, parallelism)
    scores = m.select("fold", "role", *[(F.col(c) * sign).alias(k) for k, (c, sign) in CV_METRICS.items()]) \
              .unpivot(["fold", "role"], list(CV_METRICS), "metric", "score")
    agg = scores.groupBy("metric").agg(*[
        f(F.when(F.col("role") == r, F.col("score"))).alias(f"{name}_{r}")
        for r in ("train", "test") for name, f in (("moyenne", F.avg), ("ecart_type", F.stddev_pop))])
    return agg.select("metric", "moyenne_train", "ecart_type_train", "moyenne_test", "ecart_type_test")


def cv_scores_dict(cv: DataFrame) -> dict[str, float]:
    """The reference's flat keys: ``moyenne_test_r2``, ``ecart_type_train_neg_mean_absolute_error``..."""
    out = {}
    for r in cv.collect():                      # one row per metric
        for k in ("moyenne_train", "ecart_type_train", "moyenne_test", "ecart_type_test"):
            out[f"{k}_{r['metric']}"] = r[k]
    return out


def build_scoring_rows(requests: DataFrame, encoder: OneHotModel, train_columns: list[str],
                       normalised: tuple[str, ...] = ("nom_region",)) -> DataFrame:
    """Typed columns, one-hot indicators and training column order for any number of requests.

    Columns listed in ``normalised`` are matched on normalised text (lower case,
    no accents), so a region typed or geocoded as "ile-de-france" still hits
    the "Île-de-France" indicator.
    """
    df = requests
    for c, cats in encoder.categories.items():
        if c not in df.columns:
            continue
        if c in normalised:
            key = normalize_text(F.col(c))
            ind = [key.eqNullSafe(normalize_text(F.lit(v))).cast("int").alias(f"{c}_{v}") for v in cats[1:]]
        else:
            ind = [indicator(c, v).alias(f"{c}_{v}") for v in cats[1:]]
        df = df.select(*[x for x in df.columns if x != c], *ind)
    return align_columns(df, train_columns)


def kfold_cross_validator(features: list[str], n_folds: int, fold_col: str = "fold",
                          label: str = REGRESSION_TARGET, metric: str = "rmse", param_grid=None, **overrides):
    """E8 + M2: Spark ML ``CrossValidator`` on user-given contiguous folds (``splits.k_folds``).

    Returns an unfitted ``CrossValidator``; ``fit(df)`` trains one model per fold
    in parallel-safe Spark jobs and ``avgMetrics`` holds the mean score per grid point.
    """
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    pipe = price_pipeline(features, label, **overrides)
    grid = param_grid or ParamGridBuilder().build()
    return CrossValidator(estimator=pipe, estimatorParamMaps=grid,
                          evaluator=RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric),
                          numFolds=n_folds, foldCol=fold_col, seed=overrides.get("seed", 42))
