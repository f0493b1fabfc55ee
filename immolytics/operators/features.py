"""City-by-month market features.

Plan shape at scale: the sales table is reduced once by a partial aggregate to
one row per city-month (orders of magnitude smaller); every window below runs on
that small table, partitioned by city or department, so no window ever sees raw
sales. The final join back to the sales is an equi-join that AQE turns into a
broadcast when the feature table is small, else a skew-aware sort-merge join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalar import round_half_even
from ..session import materialize
from ..settings import (CITY_KEYS, CITY_MONTH_KEYS, DEMAND_QUANTILE, DEPARTMENT_MONTH_KEYS,
                        DROPPED_AFTER_JOIN, JOIN_KEYS, LINE_KEY)
from .columns import drop_existing, require_columns, require_not_empty, to_int, with_suffix
from .halo import in_blocks


def city_month(sales: DataFrame, keys: list[str] = CITY_MONTH_KEYS, decimals: int | None = 2) -> DataFrame:
    """A1: one row per city, month and monthly volume with the mean price per m2.

    Null keys are removed first (pandas ``groupby`` drops them). ``decimals``
    rounds half to even like NumPy; ``None`` keeps the exact mean.
    """
    keyed = sales.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    mean = F.avg("prix_m2_moyen")
    if decimals is not None:
        mean = round_half_even(mean, decimals)
    return keyed.groupBy(*keys).agg(mean.alias("prix_m2_moyen"))


def department_total(cm: DataFrame, keys: list[str] = DEPARTMENT_MONTH_KEYS) -> DataFrame:
    """Monthly department volume, as a window sum (the aggregate + merge-back, without the join)."""
    w = Window.partitionBy(*keys)
    return cm.withColumn("nb_transactions_departement",
                         F.sum("nb_transactions_mois").over(w))


def market_share(cm: DataFrame) -> DataFrame:
    """A2: city share of the department's monthly volume, in percent."""
    return cm.withColumn(
        "ratio_transaction",
        F.try_divide(F.col("nb_transactions_mois"), F.col("nb_transactions_departement")) * F.lit(100))


def quantile_value(df: DataFrame, column: str, q: float, exact: bool = True,
                   accuracy: int = 100_000) -> Column:
    """A3: a global quantile as a scalar subquery (no collect of rows, no cross join).

    ``exact`` interpolates linearly between two order statistics (same value as
    pandas), see ``quantiles``; otherwise ``percentile_approx``.
    """
    if exact:
        from .quantiles import quantile_scalar
        return quantile_scalar(df, column, q)
    return df.select(F.percentile_approx(column, q, accuracy)).scalar()


def demand_flag(cm: DataFrame, threshold: float = DEMAND_QUANTILE, exact: bool = True) -> DataFrame:
    """A3+J4+A4: 1 when the share is strictly above the global ``threshold`` quantile, else 0."""
    cut = quantile_value(cm, "ratio_transaction", threshold, exact)
    return cm.withColumn("ville_demandee",
                         F.when(F.col("ratio_transaction") > cut, 1).otherwise(0))


def compute_city_features(rows: DataFrame, threshold: float = DEMAND_QUANTILE,
                          exact_quantile: bool = True, grouped: bool = False) -> DataFrame:
    """A1 without rounding (raw sales are grouped first) + J2 + A2 + A3/J4/A4.

    ``grouped`` says that ``rows`` already has one row per city, month and volume.
    """
    cm = rows if grouped else city_month(rows, decimals=None)
    return (cm.transform(department_total)
              .transform(market_share)
              .transform(demand_flag, threshold, exact_quantile))


CITY_ORDER = ["annee_transaction", "mois_transaction", "nb_transactions_mois"]


def city_window(keys: list[str] = CITY_KEYS):
    """Order of observations within a city; the volume breaks month ties deterministically."""
    return Window.partitionBy(*keys).orderBy(*CITY_ORDER)


def _over_city(cm: DataFrame, keys: list[str], back: int, columns, block: int | None) -> DataFrame:
    """``columns(window)`` over the whole city, or over blocks of ``block`` rows with the ``back`` rows before."""
    if block is None:
        return cm.withColumns(columns(city_window(keys)))
    return in_blocks(cm, keys, CITY_ORDER, back, columns, block)


def previous_month(cm: DataFrame, keys: list[str] = CITY_KEYS, block: int | None = None) -> DataFrame:
    """W1+W2: previous *observed* row per city (a gap is not filled). ``block``: see ``rolling_means``."""
    return _over_city(cm, keys, 1, lambda w: {
        "prix_m2_moyen_mois_precedent": F.lag("prix_m2_moyen").over(w),
        "nb_transactions_mois_precedent": F.lag("nb_transactions_mois").over(w)}, block)


def rolling_means(cm: DataFrame, n: int = 6, keys: list[str] = CITY_KEYS,
                  exclude_current: bool = False, block: int | None = None) -> DataFrame:
    """W3+W4: mean of the last ``n`` rows per city, null until ``n`` rows exist.

    By default the window includes the current row (as the reference computes
    it); ``exclude_current`` uses the ``n`` rows before it instead. With ``block``
    a city's rows are taken in blocks of so many, so that one very long city
    does not end up in one task; the rows of a city must differ in ``CITY_ORDER``.
    """
    hi = -1 if exclude_current else 0

    def means(w):
        frame = w.rowsBetween(hi - n + 1, hi)
        full = F.count(F.lit(1)).over(frame) == n
        return {"prix_m2_moyen_glissant": F.when(full, F.avg("prix_m2_moyen").over(frame)),
                "nb_transaction_moyen_glissant": F.when(full, F.avg("nb_transactions_mois").over(frame))}

    return with_suffix(_over_city(cm, keys, n - 1 - hi, means, block),
                       ["prix_m2_moyen_glissant", "nb_transaction_moyen_glissant"], n)


def compute_features_price_per_m2(cm: DataFrame, keys: list[str] = CITY_KEYS) -> DataFrame:
    """W1+W2, then P4 (drop rows with any null) and P6 (integer volume)."""
    out = previous_month(cm, keys).na.drop("any")
    return to_int(out, "nb_transactions_mois_precedent")


FEATURE_COLUMNS = ["prix_m2_moyen_mois_precedent", "nb_transactions_mois_precedent", "ville_demandee"]


def city_features(sales: DataFrame, decimals: int | None = 2, threshold: float = DEMAND_QUANTILE,
                  exact_quantile: bool = True, materialize_city_month: bool = True) -> DataFrame:
    """The city-month feature table: A1 -> J2 -> A2 -> A4 -> W1/W2 -> P4.

    The city-month table (one row per city and month, far smaller than the
    sales) is written once to the shared folder, so the global quantile and the
    windows read it instead of re-running the sales aggregation; the written
    table is also checked for emptiness.
    """
    cm = city_month(sales, decimals=decimals)
    if materialize_city_month:
        cm = require_not_empty(materialize(cm, "city-month"), "the city-month table")
    cm = compute_city_features(cm, threshold, exact_quantile, grouped=True)
    return compute_features_price_per_m2(cm)


def feature_engineering(sales: DataFrame, decimals: int | None = 2,
                        threshold: float = DEMAND_QUANTILE, exact_quantile: bool = True,
                        one_row_per_city_month: bool = False, materialize_city_month: bool = True,
                        line_key_of: str | None = None, city_months: DataFrame | None = None,
                        materialize_features: bool = False) -> DataFrame:
    """J1 + P2: attach the city features to every sale and drop the grouping columns.

    Like the reference, a city-month carrying several monthly volumes fans the
    sale out to one row per volume; ``one_row_per_city_month`` keeps only the
    last (largest-volume) row of each city-month instead. ``line_key_of`` names
    the sales' key and adds ``LINE_KEY``, that key with the volume of the feature
    row: unique after the fan-out, so the rows can be split and ranked exactly.
    ``city_months`` gives rows to build the features from instead of the sales;
    ``materialize_features`` writes the feature table once, for results that are read several times.
    """
    require_columns(sales, CITY_MONTH_KEYS + ["prix_m2_moyen"])
    feats = city_features(sales if city_months is None else city_months, decimals, threshold, exact_quantile,
                          materialize_city_month)
    feats = feats.select(*JOIN_KEYS, *FEATURE_COLUMNS, F.col("nb_transactions_mois").alias("_volume"))
    if one_row_per_city_month:
        w = Window.partitionBy(*JOIN_KEYS).orderBy(F.col("_volume").desc())
        feats = feats.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    if materialize_features:
        feats = materialize(feats, "features")
    prepared = sales.join(feats, JOIN_KEYS, "inner")
    if line_key_of:
        prepared = prepared.withColumn(LINE_KEY, F.concat_ws("#", line_key_of, "_volume"))
    return drop_existing(prepared, [*DROPPED_AFTER_JOIN, "_volume"], strict=True)

