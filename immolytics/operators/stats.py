"""Profile statistics (A5-A17), all in long form: one row per column (and group).

Pattern: ``unpivot`` the profiled columns into (column_name, value) and group by
``column_name``: the per-column loop of the notebooks becomes one job whose
partial aggregates are combined map-side, and different columns finish in
different tasks. Bin tables (histograms, KDE grid) are bounded by
``#columns x #bins`` whatever the data size.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .columns import categorical_columns, numeric_columns
from .quantiles import quantile_columns, same_group

QUARTILES = [0.25, 0.5, 0.75]


def long_values(df: DataFrame, columns: list[str], ids: list[str] = (), cast: str = "double",
                name: str = "column_name", value: str = "value") -> DataFrame:
    """(ids..., column_name, value) with one row per input row and column."""
    wide = df.select(*ids, *[F.col(c).cast(cast).alias(c) for c in columns])
    return wide.unpivot(list(ids), list(columns), name, value)


# ---------------------------------------------------------------- A5
def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A5: per column the type, number and share of nulls (NaN counts as missing)."""
    cols = columns or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}

    def missing(c):
        m = F.col(c).isNull()
        if isinstance(types[c], (T.DoubleType, T.FloatType)):
            m = m | F.isnan(c)
        return F.count_if(m)

    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *[missing(c).alias(c) for c in cols])
    out = one.unpivot(["n_rows"], cols, "column_name", "n_null")
    dtype = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c].simpleString()))])
    return out.select(
        "column_name", dtype[F.col("column_name")].alias("data_type"), "n_rows", "n_null",
        F.try_divide(F.col("n_null"), F.col("n_rows")).alias("null_share"))


def total_nulls(profile: DataFrame) -> DataFrame:
    return profile.agg(F.sum("n_null").alias("total_null"))


# ---------------------------------------------------------------- A6, A12, R2
def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count and share per value of each column (nulls excluded, like pandas)."""
    lv = long_values(df, columns, cast="string").where(F.col("value").isNotNull())
    counts = lv.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("column_name").agg(F.sum("n").alias("n_total"))
    return (counts.join(totals, "column_name")
                  .select("column_name", "value", "n", (F.col("n") / F.col("n_total")).alias("share")))


def count_by(df: DataFrame, column: str, hue: str | None = None) -> DataFrame:
    """Rows per category, optionally split by a second column."""
    keys = [column] + ([hue] if hue else [])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """R2: distinct values of a column."""
    return df.select(column).distinct()


# ---------------------------------------------------------------- A7, A8
def describe_numeric(df: DataFrame, columns: list[str] | None = None, exact: bool = True,
                     accuracy: int = 10_000) -> DataFrame:
    """Count, mean, std (ddof 1), min, quartiles (linear interpolation), max.

    Quartiles are exact (``quantiles.quantile_columns``); ``exact=False`` uses
    ``percentile_approx`` (one pass, bounded sketch).
    """
    cols = columns or numeric_columns(df)
    lv = long_values(df, cols)
    lv = lv.where(F.col("value").isNotNull() & ~F.isnan("value"))
    moments = [F.count("value").alias("count"), F.avg("value").alias("mean"),
               F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")]
    names = ["p25", "p50", "p75"]
    if exact:
        agg = lv.groupBy("column_name").agg(*moments)
        agg = agg.join(quantile_columns(lv, "value", QUARTILES, names, ["column_name"]), "column_name", "left")
    else:
        agg = lv.groupBy("column_name").agg(
            *moments, F.percentile_approx("value", QUARTILES, accuracy).cast("array<double>").alias("_q"))
        agg = agg.select("*", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)]).drop("_q")
    return agg.select("column_name", "count", "mean", "std", "min", *names, "max")


def describe_categorical(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, unique, top (most frequent, ties to the smallest value), freq."""
    cols = columns or categorical_columns(df)
    lv = long_values(df, cols, cast="string").where(F.col("value").isNotNull())
    counts = lv.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct((-F.col("n")).alias("neg_n"), F.col("value"))
    return counts.groupBy("column_name").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", order).alias("top"), F.max("n").alias("freq"))


# ---------------------------------------------------------------- A9, A10
def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson r for every pair i < j as a long table (col_a, col_b, r).

    Pairwise-complete like pandas; a constant column gives NULL. Every row is the
    vector (presence, centred value, its square) per column; the Gram matrix of
    these vectors, tree-aggregated in one pass, holds the counts, sums, squares
    and products of every pair of columns, gaps included. The means that centre
    the values come from one pass before. The numeric projection is persisted
    (memory and disk) for the two passes; 3p x 3p numbers reach the driver.
    """
    from pyspark.ml.functions import array_to_vector
    from pyspark.mllib.linalg.distributed import RowMatrix
    from pyspark.mllib.util import MLUtils
    cols = columns or numeric_columns(df)
    spark, p = df.sparkSession, len(cols)
    schema = "col_a string, col_b string, r double"
    num = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    num = num.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        means = num.agg(*[F.avg(c).alias(f"a{i}") for i, c in enumerate(cols)]).first()
        if p < 2 or all(m is None for m in means):
            return spark.createDataFrame([(a, b, None) for i, a in enumerate(cols) for b in cols[i + 1:]], schema)
        centred = [F.coalesce(F.col(c) - F.lit(means[f"a{i}"] or 0.0), F.lit(0.0)) for i, c in enumerate(cols)]
        present = [F.col(c).isNotNull().cast("double") for c in cols]
        vector = array_to_vector(F.array(*present, *centred, *[x * x for x in centred])).alias("v")
        gram = RowMatrix(MLUtils.convertVectorColumnsFromML(num.select(vector), "v")).computeGramianMatrix().toArray()
    finally:
        num.unpersist()
    rows: list[tuple] = []
    for i, a in enumerate(cols):
        for j in range(i + 1, p):
            n = gram[i, j]
            r = None
            if n:
                ma, mb = gram[p + i, j] / n, gram[i, p + j] / n
                saa, sbb = gram[2 * p + i, j] / n, gram[i, 2 * p + j] / n
                va, vb = saa - ma * ma, sbb - mb * mb
                # a constant column leaves only rounding noise in its variance: NULL, like the SQL twin
                if va > 1e-12 * saa and vb > 1e-12 * sbb:
                    r = float((gram[p + i, p + j] / n - ma * mb) / math.sqrt(va * vb))
            rows.append((a, cols[j], r))
    return spark.createDataFrame(rows, schema)


def strong_pairs(corr: DataFrame, threshold: float = 0.7) -> DataFrame:
    """A10: pairs with |r| above the threshold."""
    return corr.where(F.abs("r") > threshold)


# ---------------------------------------------------------------- A11
def crosstab(df: DataFrame, column: str, target: str, values: list) -> DataFrame:
    """Counts of category x target value, zeros included (columns ``n_<value>``)."""
    wide = df.groupBy(column).pivot(target, values).agg(F.count(F.lit(1)))
    return wide.select(column, *[F.coalesce(F.col(str(v)), F.lit(0)).alias(f"n_{v}") for v in values])


# ---------------------------------------------------------------- A13, A14
def clean_doubles(df: DataFrame, columns: list[str], ids: list[str] = ()) -> DataFrame:
    """``ids`` and the columns as doubles, NaN as NULL."""
    return df.select(*ids, *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])


def extents(wide: DataFrame, columns: list[str], **more) -> tuple[DataFrame, dict[str, dict[str, Column]]]:
    """One row per column with lo, hi and further aggregates, and the same numbers as scalar subqueries.

    Both come from one aggregate of the wide frame: rows look the numbers up in
    the plan instead of being shuffled to them.
    """
    stats = {"lo": F.min, "hi": F.max, **more}
    one = wide.agg(*[f(c).alias(f"{k}_{i}") for i, c in enumerate(columns) for k, f in stats.items()])
    table = one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{k}_{i}").alias(k) for k in stats])
        for i, c in enumerate(columns)])))
    scalars = {c: {k: one.select(f"{k}_{i}").scalar() for k in ("lo", "hi")} for i, c in enumerate(columns)}
    return table, scalars


def _bin(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """1-based equal-width bin; the maximum falls into the last one."""
    pos = F.floor(F.try_divide(value - lo, hi - lo) * bins) + 1
    return F.when(value.isNull(), F.lit(None)).when(hi == lo, F.lit(1)).otherwise(F.least(pos, F.lit(bins))).cast("int")


def histogram(df: DataFrame, columns: list[str], bins: int = 20, by: str | None = None,
              density: bool = False) -> DataFrame:
    """Equal-width bin counts per column, zero bins included.

    With ``by`` every group is counted on the same edges (conditional
    distribution). ``density`` divides by (group total x bin width). Values are
    binned in place; only (column, group, bin) counts are shuffled.
    """
    ids = [by] if by else []
    wide = clean_doubles(df, columns, ids)
    edges, at = extents(wide, columns)
    edges = edges.where(F.col("lo").isNotNull())
    binned = wide.select(*ids, *[_bin(F.col(c), at[c]["lo"], at[c]["hi"], bins).alias(c) for c in columns])
    counts = (binned.unpivot(ids, columns, "column_name", "bin").where(F.col("bin").isNotNull())
              .groupBy("column_name", *ids, "bin").agg(F.count(F.lit(1)).alias("n")))
    grid = edges.select("column_name", "lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    if by:
        grid = grid.join(counts.select("column_name", by).distinct(), "column_name")
    out = grid.join(counts, ["column_name", *ids, "bin"], "left")
    w = (F.col("hi") - F.col("lo")) / bins
    out = out.select("column_name", *ids, "bin",
                     (F.col("lo") + (F.col("bin") - 1) * w).alias("bin_lo"),
                     (F.col("lo") + F.col("bin") * w).alias("bin_hi"),
                     F.coalesce(F.col("n"), F.lit(0)).alias("n"))
    if density:
        tot = out.groupBy("column_name", *ids).agg(F.sum("n").alias("_t"))
        out = (out.join(tot, ["column_name", *ids])
                  .withColumn("density", F.try_divide(F.col("n"), F.col("_t") * (F.col("bin_hi") - F.col("bin_lo"))))
                  .drop("_t"))
    return out


# ---------------------------------------------------------------- A15
SALTS = 32


def boxplot_stats(df: DataFrame, columns: list[str], by: str | None = None, whis: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (furthest points inside the 1.5 IQR fences) and outlier count.

    Rows become (column, group, value) counts first; the quartiles meet them on a
    salted key, so a column or group that holds most rows is spread over tasks.
    """
    ids = [by] if by else []
    keys = ["column_name", *ids]
    lv = clean_doubles(df, columns, ids).unpivot(ids, columns, "column_name", "value").where(F.col("value").isNotNull())
    q = quantile_columns(lv, "value", QUARTILES, ["q1", "median", "q3"], keys)
    counts = (lv.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("c"))
              .withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(SALTS)).cast("int")))
    salted = q.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    iqr = F.col("q3") - F.col("q1")
    inside = (F.col("value") >= F.col("q1") - whis * iqr) & (F.col("value") <= F.col("q3") + whis * iqr)
    return same_group(counts, salted, keys + ["salt"]).groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_hi"),
        F.sum(F.when(inside, 0).otherwise(F.col("c"))).cast("long").alias("n_outliers"),
        F.sum("c").alias("n"))


# ---------------------------------------------------------------- A16
def kde(df: DataFrame, columns: list[str], grid_size: int = 200, per_bandwidth: int = 8,
        cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on a grid, Scott bandwidth ``h = std * n^(-1/5)``.

    Rows are first counted into bins of width ``h / per_bandwidth`` (only those
    that hold rows exist); the kernel sum then runs over bins x grid points. Rows
    are binned in place and only the counts are shuffled.
    """
    wide = clean_doubles(df, columns)
    table, at = extents(wide, columns, sd=F.stddev_samp, n=F.count)
    st = table.withColumn("h", F.col("sd") * F.pow(F.col("n"), F.lit(-0.2))).where(F.col("h") > 0)
    one = wide.agg(*[(F.stddev_samp(c) * F.pow(F.count(c), F.lit(-0.2))).alias(f"h_{i}") for i, c in enumerate(columns)])
    position = [F.floor(F.try_divide(F.col(c) - at[c]["lo"], one.select(f"h_{i}").scalar() / per_bandwidth)).alias(c)
                for i, c in enumerate(columns)]
    binned = (wide.select(*position).unpivot([], columns, "column_name", "b").where(F.col("b").isNotNull())
              .groupBy("column_name", "b").agg(F.count(F.lit(1)).alias("c")))
    start = F.col("lo") - cut * F.col("h")
    step = (F.col("hi") - F.col("lo") + 2 * cut * F.col("h")) / (grid_size - 1)
    grid = st.select("column_name", "lo", "h", "n", start.alias("start"), step.alias("step"),
                     F.explode(F.sequence(F.lit(0), F.lit(grid_size - 1))).alias("g"))
    grid = grid.select("column_name", "g", "lo", "h", "n", (F.col("start") + F.col("g") * F.col("step")).alias("x"))
    centre = F.col("lo") + (F.col("b") + 0.5) * (F.col("h") / per_bandwidth)
    z = (F.col("x") - centre) / F.col("h")
    k = F.col("c") * F.exp(-0.5 * z * z) / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))
    return (binned.join(F.broadcast(grid), "column_name")            # columns x grid_size rows
                  .groupBy("column_name", "g", "x").agg(F.sum(k).alias("density")))


# ---------------------------------------------------------------- A17
def grid_counts(df: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """Joint distribution of two columns on an equal-width 2-D grid."""
    d = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")) \
          .where(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y"))
    _, at = extents(d, ["x", "y"])
    return (d.select(F.lit(x).alias("x_column"), F.lit(y).alias("y_column"),
                     *[_bin(F.col(v), at[v]["lo"], at[v]["hi"], bins).alias(f"{v}_bin") for v in ("x", "y")])
             .groupBy("x_column", "y_column", "x_bin", "y_bin").agg(F.count(F.lit(1)).alias("n")))


def pair_grid(df: DataFrame, columns: list[str], bins: int = 20) -> DataFrame:
    """A17 for all pairs of columns: (x_column, y_column, x_bin, y_bin, n), x before y in ``columns``.

    Every row is binned once, on the edges of each column's own values, and adds a
    cell per pair; only counts are shuffled, p(p-1)/2 x bins^2 of them per task at
    most. A pair counts the rows that have both values. ``df`` is read twice (for
    the extents, then for the cells): write a dear one first.
    """
    if len(columns) < 2 or len(set(columns)) < len(columns):
        raise ValueError("pairs need two different columns or more")
    wide = clean_doubles(df, columns)
    _, at = extents(wide, columns)
    binned = wide.select(*[_bin(F.col(c), at[c]["lo"], at[c]["hi"], bins).alias(c) for c in columns])
    cells = F.array(*[F.struct(F.lit(x).alias("x_column"), F.lit(y).alias("y_column"), F.col(x).alias("x_bin"), F.col(y).alias("y_bin"))
                      for i, x in enumerate(columns) for y in columns[i + 1:]])
    return (binned.select(F.inline(cells)).where("x_bin IS NOT NULL AND y_bin IS NOT NULL")
            .groupBy("x_column", "y_column", "x_bin", "y_bin").agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- R1
def top_values(df: DataFrame, order_col: str, k: int, tie: str) -> DataFrame:
    """The k first rows by ``order_col`` descending, ties broken by ``tie``."""
    return df.orderBy(F.col(order_col).desc(), F.col(tie).asc()).limit(k)

