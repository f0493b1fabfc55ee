"""One-hot encoding with a dropped first category (E3-E6, M11 alignment).

The fitted state is the sorted category list per column (a small table, like a
``StringIndexerModel``'s labels). Spark ML's ``OneHotEncoder`` cannot express
"drop the first category and map unknowns to all zeros" (``handleInvalid='keep'``
drops the reserved bucket instead), so the indicators are plain expressions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .columns import require_columns
from .stats import long_values


@dataclass
class OneHotModel:
    """Sorted categories per column; the first one is the dropped reference level."""
    categories: dict[str, list[str]] = field(default_factory=dict)

    def feature_names(self, column: str) -> list[str]:
        return [f"{column}_{c}" for c in self.categories[column][1:]]

    @property
    def all_feature_names(self) -> list[str]:
        return [n for c in self.categories for n in self.feature_names(c)]

    # Persistence as a small parquet table (column, position, category)
    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(c, i, v) for c, vals in self.categories.items() for i, v in enumerate(vals)]
        (spark.createDataFrame(rows, "column_name string, position int, category string")
              .coalesce(1).write.mode("overwrite").parquet(path))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> OneHotModel:
        cats: dict[str, list[str]] = {}
        for r in spark.read.parquet(path).orderBy("column_name", "position").collect():
            cats.setdefault(r["column_name"], []).append(r["category"])
        return cls(cats)


# An indicator column is made per category: for more than this many in all, ``categories`` gives one sparse vector.
MOST_CATEGORIES = 10_000


def fit_one_hot(df: DataFrame, columns: list[str], most: int = MOST_CATEGORIES) -> OneHotModel:
    """Distinct non-null categories of every column in one job, sorted by code point.

    Raises ``ValueError`` if the columns have more than ``most`` categories together.
    """
    require_columns(df, columns)
    lv = long_values(df, columns, cast="string").where(F.col("value").isNotNull()).distinct()
    cats: dict[str, list[str]] = {c: [] for c in columns}
    found = lv.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} categories in {columns}: use categories.fit_categories (sparse vectors)")
    for r in found:
        cats[r["column_name"]].append(r["value"])
    return OneHotModel({c: sorted(v) for c, v in cats.items()})


def indicator(column: str, category: str) -> Column:
    """1 when the value equals ``category``; 0 otherwise, including NULL and unknowns."""
    return F.col(column).cast("string").eqNullSafe(F.lit(category)).cast("int")


def transform_one_hot(df: DataFrame, model: OneHotModel) -> DataFrame:
    """Replace each encoded column by its ``{column}_{category}`` indicators."""
    require_columns(df, list(model.categories))
    keep = [F.col(c) for c in df.columns if c not in model.categories]
    ind = [indicator(c, v).alias(f"{c}_{v}") for c, vals in model.categories.items() for v in vals[1:]]
    return df.select(*keep, *ind)


def inverse_one_hot(df: DataFrame, column: str, categories: list[str]) -> DataFrame:
    """Rebuild the category; all-zero indicators give the dropped first category."""
    names = [f"{column}_{c}" for c in categories[1:]]
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"indicator columns missing: {missing}")
    value = F.coalesce(*[F.when(F.col(n) == 1, F.lit(c)) for n, c in zip(names, categories[1:])],
                       F.lit(categories[0]))
    return df.withColumn(column, value).drop(*names)
