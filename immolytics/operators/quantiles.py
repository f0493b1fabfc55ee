"""Exact grouped quantiles on one distributed path, whatever the size of a group.

A quantile is the linear interpolation of two order statistics. Rows are first
reduced to (group, value) counts, so a value held by a third of the rows is one
row. Counts are then narrowed twice: a coarse bucket that follows the order of
doubles (sign and logarithm) tells by prefix sums which buckets hold the wanted
ranks, equal slices of those buckets tell which slices do, and only the counts
in these slices are ranked by a window. No step gathers a group in one task, no
job runs while the plan is built, and nothing passes through the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

# Coarse buckets per power of two, and equal slices of a coarse bucket.
PER_OCTAVE = 16
SLICES = 1024


def ordered_bucket(value: Column) -> Column:
    """An integer that never falls as the double ``value`` rises; infinities lie outside all others."""
    size = F.floor(F.log2(F.abs(value)) * PER_OCTAVE) + 1100 * PER_OCTAVE      # doubles start at 2^-1074
    size = F.when(F.abs(value) == float("inf"), F.lit(1 << 40)).otherwise(size)
    return F.when(value == 0, F.lit(0)).when(value > 0, size).otherwise(-size).cast("long")


def same_group(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where a null group equals itself; the keys come from the left side."""
    renamed = right.select([F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    if not keys:
        return left.crossJoin(renamed)                       # both sides are one group
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, match, how).drop(*[f"__r_{k}" for k in keys])


def _ranks(total: Column, probs: list[float]) -> list[tuple[Column, Column, Column]]:
    """Per probability the two 1-based ranks to interpolate and the weight of the second."""
    out = []
    for p in probs:
        h = (total - 1) * F.lit(float(p))
        low = F.floor(h)
        out.append(((low + 1).cast("long"), F.least(low + 2, total).cast("long"), h - low))
    return out


def _holding(buckets: DataFrame, keys: list[str], order: str, probs: list[float], start: Column) -> DataFrame:
    """Buckets (with ``_n`` rows each, ``start`` rows before all) that hold a wanted rank, with ``_before``."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = buckets.withColumn("_before", start + F.coalesce(F.sum("_n").over(w), F.lit(0)))
    wanted = [(r > F.col("_before")) & (r <= F.col("_before") + F.col("_n"))
              for a, b, _ in _ranks(F.col("_total"), probs) for r in (a, b)]
    return placed.where(reduce(lambda a, b: a | b, wanted))


def quantile_columns(df: DataFrame, value: str | Column, probs: list[float], names: list[str],
                     by: list[str] = ()) -> DataFrame:
    """One row per group with one exact quantile (linear interpolation) per probability.

    NULL and NaN are ignored; null groups are groups; infinities sort outside.
    """
    by = list(by)
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    base = df.select(*by, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if not by:                                               # one group, its buckets spread over tasks
        base, by_keys = base.withColumn("_all", F.lit(0)), ["_all"]
    else:
        by_keys = by
    counts = (base.groupBy(*by_keys, (F.col("_v") + F.lit(0.0)).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_b", ordered_bucket(F.col("_v"))))
    coarse = counts.groupBy(*by_keys, "_b").agg(F.sum("_n").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    coarse = coarse.withColumn("_total", F.sum("_n").over(Window.partitionBy(*by_keys)))
    held = _holding(coarse, by_keys, "_b", probs, F.lit(0)).drop("_n")
    slice_ = F.floor(F.try_divide(F.col("_v") - F.col("_lo"), F.col("_hi") - F.col("_lo")) * SLICES)
    inner = same_group(counts, held, by_keys + ["_b"]).withColumn(
        "_s", F.when(F.col("_hi") > F.col("_lo"), F.least(slice_, F.lit(SLICES - 1))).otherwise(0).cast("int"))
    slices = (inner.groupBy(*by_keys, "_b", "_s", "_total", F.col("_before").alias("_start"))
              .agg(F.sum("_n").alias("_n")))
    fine = _holding(slices, by_keys + ["_b"], "_s", probs, F.col("_start")).select(
        *by_keys, "_b", "_s", F.col("_before").alias("_from"))
    last = same_group(inner, fine, by_keys + ["_b", "_s"])
    run = Window.partitionBy(*by_keys, "_b", "_s").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = last.withColumn("_upto", F.col("_from") + F.sum("_n").over(run))
    aggs = []
    for i, (a, b, weight) in enumerate(_ranks(F.col("_total"), probs)):
        for side, r in (("a", a), ("b", b)):
            here = (r <= F.col("_upto")) & (r > F.col("_upto") - F.col("_n"))
            aggs.append(F.max(F.when(here, F.col("_v"))).alias(f"_{side}{i}"))
        aggs.append(F.max(weight).alias(f"_w{i}"))
    found = placed.groupBy(*by_keys).agg(*aggs)

    def between(i: int) -> Column:
        a, b = F.col(f"_a{i}"), F.col(f"_b{i}")
        return F.when((a == b) | (F.col(f"_w{i}") == 0), a).otherwise(a + F.col(f"_w{i}") * (b - a))

    out = found.select(*by_keys, *[between(i).alias(n) for i, n in enumerate(names)])
    return out if by else out.drop("_all")


def quantile_scalar(df: DataFrame, value: str, p: float) -> Column:
    """One global quantile as a scalar subquery."""
    return quantile_columns(df, value, [p], ["q"]).select("q").scalar()
