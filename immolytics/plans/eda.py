"""Exploratory profile of a sales table: the notebook's sequence as one call."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import stats
from ..operators.columns import categorical_columns, continuous_columns, numeric_columns
from ..settings import CLASSIFICATION_TARGET, STRONG_CORRELATION


def profile(df: DataFrame, target: str = CLASSIFICATION_TARGET, bins: int = 20) -> dict[str, DataFrame]:
    """Null profile, numeric and categorical descriptions, value counts, correlations (and the
    strongly correlated pairs), histograms (overall and by target), box plots and crosstabs
    against the target. Column kinds come from the schema plus one distinct-count pass."""
    num = numeric_columns(df)
    cats = categorical_columns(df)
    cont = continuous_columns(df, exclude=(target,))
    corr = stats.correlation_matrix(df, num)
    out = {
        "nulls": stats.null_profile(df),
        "describe_numeric": stats.describe_numeric(df, num),
        "correlation": corr,
        "strong_pairs": stats.strong_pairs(corr, STRONG_CORRELATION),
        "histogram": stats.histogram(df, cont, bins),
        "boxplot": stats.boxplot_stats(df, cont),
    }
    if cats:
        out["describe_categorical"] = stats.describe_categorical(df, cats)
        out["value_counts"] = stats.value_counts(df, cats)
    if target in df.columns:
        out["by_target"] = stats.histogram(df, cont, bins, by=target)
        for c in cats:
            out[f"crosstab_{c}"] = stats.crosstab(df, c, target, [0, 1])
    return out
