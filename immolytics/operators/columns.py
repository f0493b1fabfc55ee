"""Projections, guards and casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..settings import CLASSIFICATION_TARGET, LOADED_COLUMNS, REGRESSION_TARGET


def require_columns(df: DataFrame, columns: list[str]) -> None:
    """Schema guard (no job): raise ``ValueError`` naming the first missing column."""
    for c in columns:
        if c not in df.columns:
            raise ValueError(f"La colonne {c} n'existe pas dans le DataFrame.")


def require_not_empty(df: DataFrame, what: str = "input") -> DataFrame:
    """Emptiness guard: reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def strip_column_names(df: DataFrame) -> DataFrame:
    """Names stripped of surrounding blanks."""
    return df.toDF(*[c.strip() for c in df.columns])


def keep_known_columns(df: DataFrame, wanted: list[str] = LOADED_COLUMNS,
                       extra: list[str] = ()) -> DataFrame:
    """Project onto an allow-list in list order, silently skipping absent names.

    ``extra`` columns (e.g. a row key) are kept first when present.
    """
    keep = [c for c in list(extra) + list(wanted) if c in df.columns]
    return df.select(*keep)


def drop_existing(df: DataFrame, columns: list[str], strict: bool = True) -> DataFrame:
    """Drop columns; a missing name raises (as pandas does) unless ``strict=False``."""
    if strict:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise KeyError(f"columns not found: {missing}")
    return df.drop(*columns)


def slice_by_value(df: DataFrame, column: str, value) -> DataFrame:
    """Rows where ``column`` equals ``value``."""
    return df.where(F.col(column) == F.lit(value))


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows having a null in any (or the given) column; NaN counts as missing."""
    cols = subset or df.columns
    numeric = {f.name for f in df.schema.fields
               if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cond = None
    for c in cols:
        bad = F.col(c).isNull() | (F.isnan(c) if c in numeric else F.lit(False))
        cond = bad if cond is None else (cond | bad)
    return df if cond is None else df.where(~cond)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn floating NaN into NULL (pandas skips NaN; Spark aggregates would not)."""
    return df.select(*[
        F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def with_suffix(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    """P5: rename computed columns with the window-length suffix ``_{n}m``."""
    return df.withColumnsRenamed({c: f"{c}_{n}m" for c in columns if c in df.columns})


def to_int(df: DataFrame, column: str, kind: str = "bigint") -> DataFrame:
    """Integer cast."""
    return df.withColumn(column, F.col(column).cast(kind))


def feature_columns(df: DataFrame, targets: tuple[str, ...] = (REGRESSION_TARGET, CLASSIFICATION_TARGET),
                    keys: tuple[str, ...] = ()) -> list[str]:
    """The feature columns (everything except targets and row keys)."""
    return [c for c in df.columns if c not in targets and c not in keys]


def align_columns(df: DataFrame, columns: list[str], fill=0) -> DataFrame:
    """Training column order; absent columns become ``fill``, extras are dropped."""
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(fill).alias(c) for c in columns])


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Numeric columns by schema (no job)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def categorical_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in exclude]


def continuous_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Numeric columns with more than two distinct values.

    A column has a third value if and only if some value lies strictly between
    its minimum and its maximum: two plain aggregates, no distinct counts.
    """
    num = numeric_columns(df, exclude)
    if not num:
        return []
    wide = nan_to_null(df.select(*num))
    ends = wide.agg(*[F.min(c).alias(f"lo_{i}") for i, c in enumerate(num)], *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(num)])
    row = wide.agg(*[F.count_if((F.col(c) > ends.select(f"lo_{i}").scalar()) & (F.col(c) < ends.select(f"hi_{i}").scalar()))
                     .alias(f"n_{i}") for i, c in enumerate(num)]).first()
    return [c for i, c in enumerate(num) if row[f"n_{i}"]]


def price_per_m2(prediction: str | Column = "prediction", surface: str | Column = "surface_habitable") -> Column:
    """P10: predicted price per m2; NULL on a zero surface."""
    return F.try_divide(prediction if isinstance(prediction, Column) else F.col(prediction),
                        surface if isinstance(surface, Column) else F.col(surface))
