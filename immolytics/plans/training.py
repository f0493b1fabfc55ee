"""Split, encode, train, evaluate: the training flow as DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import categories, encode, model as pm, splits
from ..operators.columns import feature_columns, require_columns, require_not_empty, strip_column_names
from ..operators.metrics import evaluate
from ..settings import CLASSIFICATION_TARGET, COLS_TO_ENCODE, RANDOM_STATE, REGRESSION_TARGET, ROW_KEY, TEST_SIZE

# Names of the logged evaluation metrics, with the columns of ``evaluate``.
EVALUATION_METRICS = {"{} RMSE": "rmse", "{} MAE": "mae", "{} R2": "r2", "{}_Error_Mean": "error_mean",
                      "{}_Error_Std": "error_std"}


def split_and_encode(data: DataFrame, target_class: str = CLASSIFICATION_TARGET,
                     target_reg: str = REGRESSION_TARGET, cols_to_encode: list[str] | None = COLS_TO_ENCODE,
                     key_columns: list[str] = (ROW_KEY,), test_size: float = TEST_SIZE,
                     seed: int = RANDOM_STATE, sparse: bool = False) -> dict:
    """E5: exact seeded split, encoders fitted on train only, applied to both.

    Targets stay in the frames as their own columns (no positional re-zip).
    Returns ``{"train", "test", "encoders", "features"}``. ``sparse`` gives one vector
    column ``indicators`` (any number of categories) in place of a column per category.
    """
    data = strip_column_names(data)
    require_columns(data, list(cols_to_encode or []))
    train, test = splits.train_test_split(data, list(key_columns), test_size, seed)
    if sparse:
        model = categories.fit_categories(train, list(cols_to_encode or []))
        vector = categories.as_vector("indicators", model.n_features)
        train, test = (categories.transform_sparse(part, model).withColumn("indicators", vector) for part in (train, test))
    else:
        model = encode.fit_one_hot(train, list(cols_to_encode or []))
        train, test = encode.transform_one_hot(train, model), encode.transform_one_hot(test, model)
    features = feature_columns(train, (target_class, target_reg), tuple(key_columns))
    return {"train": train, "test": test, "encoders": model, "features": features}


def error_analysis(model, train: DataFrame, test: DataFrame, label: str = REGRESSION_TARGET,
                   runlog=None, parent_id: str | None = None) -> DataFrame:
    """M4 with the reference's empty-input guard; with a run log the ten metrics go to a nested run."""
    for d, what in ((train, "train"), (test, "test")):
        require_not_empty(d, f"{what} set")
    scored = (pm.score(model, train).withColumn("split", F.lit("train"))
              .unionByName(pm.score(model, test).withColumn("split", F.lit("test"))))
    out = evaluate(scored, label)
    if runlog is not None:
        rows = {r["split"]: r for r in out.collect()}      # one row per split
        run_id = runlog.start_run("model_evaluation", tags={"Run_Type": "model_evaluation"}, parent_id=parent_id)
        runlog.log_metrics(run_id, {name.format(split.capitalize()): rows[split][column]
                                    for split in ("train", "test") for name, column in EVALUATION_METRICS.items()})
    return out


def train_and_log_model(prepared: DataFrame, order_columns: list[str], runlog=None, n_splits: int = 5,
                        key_columns: list[str] = (ROW_KEY,), **gbt_overrides) -> dict:
    """E5 -> E7 -> M2 -> M1 (+ S9): cross-validate on expanding folds of the training rows, fit on all
    of them, log parameters and scores. Returns the model, encoders, feature list, CV table and splits."""
    parts = split_and_encode(prepared, key_columns=list(key_columns))
    train, test, features = parts["train"], parts["test"], parts["features"]
    cv = pm.cross_validate(splits.time_series_blocks(train, list(order_columns), n_splits),
                           pm.gbt_fitter(features, **gbt_overrides), n_splits)
    model = pm.train_price_model(train, features, **gbt_overrides)
    if runlog is not None:
        from ..settings import GBT_PARAMS
        run_id = runlog.start_run("training_run", tags={"Run_Type": "model_training"},
                                  params={**GBT_PARAMS, **gbt_overrides})
        runlog.log_metrics(run_id, pm.cv_scores_dict(cv))
    return {"model": model, "encoders": parts["encoders"], "features": features, "cv": cv,
            "train": train, "test": test}
