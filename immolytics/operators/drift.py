"""Data drift between a reference and a current frame.

Numeric columns: Kolmogorov-Smirnov distance and Wasserstein-1 (plain and
divided by the reference population std) from the two empirical CDFs.
Categorical columns: Jensen-Shannon distance (base 2) and the chi-square
statistic of the 2 x k count table.

Plan at scale: one scan reduces the rows to (column, value) counts for both
sides, so a value held by a third of the rows is a single row; everything else
works on the counts. Cumulative sums run per (column, slice) of the values, offset
by a small table of slice counts: exact CDFs without a task ever sorting a whole
column. The slices lie between quantiles of the distinct values, so each holds
about as many of them whatever their distribution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..settings import DRIFT_SHARE_GATE, DRIFT_THRESHOLD
from .quantiles import same_group

REF = "_is_ref"


def tagged(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Both sides in one frame; ``REF`` marks the reference rows."""
    return (reference.select(*columns).withColumn(REF, F.lit(True))
            .unionByName(current.select(*columns).withColumn(REF, F.lit(False))))


# Slices of a column (a power of two), and the accuracy of the quantiles between them (a twentieth of a slice).
SLICES = 1024


def value_counts_by_side(rows: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """(column_name, number, text, numeric, n_ref, n_cur) of all columns from one scan of ``rows`` (with ``REF``).

    ``numeric`` is an aggregate, so that choosing by it leaves the aggregate as it
    is: numeric and categorical statistics reuse one shuffle of the counts.
    """
    none, blank = F.lit(None).cast("double"), F.lit(None).cast("string")
    cells = [F.struct(F.lit(c).alias("column_name"), F.nanvl(F.col(c).cast("double"), none).alias("number"),
                      blank.alias("text")) for c in numeric]
    cells += [F.struct(F.lit(c).alias("column_name"), none.alias("number"), F.col(c).cast("string").alias("text"))
              for c in categorical]
    long = rows.select(REF, F.inline(F.array(*cells))).where("number IS NOT NULL OR text IS NOT NULL")
    return long.groupBy("column_name", "number", "text").agg(
        F.bool_or(F.col("number").isNotNull()).alias("numeric"),
        F.count_if(F.col(REF)).alias("n_ref"), F.count_if(~F.col(REF)).alias("n_cur"))


def sliced(c: DataFrame, slices: int = SLICES) -> DataFrame:
    """``c`` (a row per distinct ``value`` of a column) with the slice ``s`` of every value.

    Splitters are quantiles of the values, from mergeable sketches; a value's slice
    is the number of splitters up to it, found by bisection.
    """
    shares = [i / slices for i in range(1, slices)]
    # The other columns are looked at too, and the join is null-safe, so that all branches read one shuffle of the counts.
    there = c.where(sum((F.col(n) for n in c.columns if n.startswith("n_")), F.lit(1)) > 0)
    splitters = there.groupBy("column_name").agg(F.percentile_approx("value", shares, 20 * slices).alias("at"))
    steps = F.array(*[F.lit(1 << k) for k in range(slices.bit_length() - 2, -1, -1)])
    place = F.aggregate(steps, F.lit(0), lambda s, step: F.when(F.col("at")[s + step - 1] <= F.col("value"), s + step).otherwise(s))
    return same_group(c, F.broadcast(splitters), ["column_name"]).withColumn("s", place).drop("at")        # a row per column


def numeric_drift(counts: DataFrame) -> DataFrame:
    """Per numeric column of ``value_counts_by_side``: ks, wasserstein, wasserstein_norm (exact).

    Cumulative counts run within slices of about equally many values, offset by the
    counts of the slices before, so no task sorts a whole column.
    """
    c = sliced(counts.where("numeric").select("column_name", F.col("number").alias("value"), "n_ref", "n_cur"))
    keys = ["column_name", "s"]
    whole = Window.partitionBy("column_name")
    wb = whole.orderBy("s")
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    totals = c.groupBy(*keys).agg(F.sum("n_ref").alias("r"), F.sum("n_cur").alias("k"), F.min("value").alias("first"),
                                  F.sum(F.col("n_ref") * F.col("value")).alias("sum_ref"))
    tot_ref, tot_cur = F.sum("r").over(whole), F.sum("k").over(whole)
    bt = totals.select(*keys, tot_ref.alias("tot_ref"), tot_cur.alias("tot_cur"),
                       F.try_divide(F.coalesce(F.sum("r").over(before), F.lit(0)), tot_ref).alias("off_ref"),
                       F.try_divide(F.coalesce(F.sum("k").over(before), F.lit(0)), tot_cur).alias("off_cur"),
                       F.lead("first").over(wb).alias("next_min"),
                       F.try_divide(F.sum("sum_ref").over(whole), tot_ref).alias("mean_ref"))
    wv = Window.partitionBy(*keys).orderBy("value")
    run = wv.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = (same_group(c, bt, keys)                            # null-safe: no filter parts the branches' plans
          .withColumn("F_ref", F.col("off_ref") + F.try_divide(F.sum("n_ref").over(run), F.col("tot_ref")))
          .withColumn("F_cur", F.col("off_cur") + F.try_divide(F.sum("n_cur").over(run), F.col("tot_cur")))
          .withColumn("nxt", F.coalesce(F.lead("value").over(wv), F.col("next_min"))))
    d = F.abs(F.col("F_ref") - F.col("F_cur"))
    off = F.col("value") - F.col("mean_ref")
    out = c.groupBy("column_name").agg(
        F.max(d).alias("ks"),
        F.sum(F.coalesce(d * (F.col("nxt") - F.col("value")), F.lit(0.0))).alias("wasserstein"),
        F.sqrt(F.try_divide(F.sum(F.col("n_ref") * off * off), F.max("tot_ref"))).alias("ref_std"))
    return out.select("column_name", "ks", "wasserstein",
                      (F.col("wasserstein") / F.greatest(F.col("ref_std"), F.lit(0.001))).alias("wasserstein_norm"))


def categorical_drift(counts: DataFrame) -> DataFrame:
    """Per categorical column of ``value_counts_by_side``: jensen_shannon (base 2, distance) and chi2."""
    cnt = counts.where("NOT numeric")
    tot = cnt.groupBy("column_name").agg(F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"))
    c = cnt.join(F.broadcast(tot), "column_name")                             # one row per column
    p, q = F.try_divide(F.col("n_ref"), F.col("tot_ref")), F.try_divide(F.col("n_cur"), F.col("tot_cur"))
    m = (p + q) / 2

    def kl_term(x):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    grand = F.col("tot_ref") + F.col("tot_cur")
    row = F.col("n_ref") + F.col("n_cur")
    e_ref, e_cur = F.try_divide(row * F.col("tot_ref"), grand), F.try_divide(row * F.col("tot_cur"), grand)
    chi = F.try_divide((F.col("n_ref") - e_ref) ** 2, e_ref) + F.try_divide((F.col("n_cur") - e_cur) ** 2, e_cur)
    out = c.groupBy("column_name").agg(
        F.sum(0.5 * kl_term(p) + 0.5 * kl_term(q)).alias("_jsd"), F.sum(chi).alias("chi2"))
    return out.select("column_name", F.sqrt(F.greatest(F.col("_jsd"), F.lit(0.0))).alias("jensen_shannon"), "chi2")


def report_of(counts: DataFrame, numeric: bool = True, categorical: bool = True, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """M5 from counts: one row per column with its statistics, the drift score (a distance) and the drift flag."""
    none = F.lit(None).cast("double")
    parts = []
    if numeric:
        parts.append(numeric_drift(counts).select(
            "column_name", F.lit("numeric").alias("kind"), "ks", "wasserstein", "wasserstein_norm",
            none.alias("jensen_shannon"), none.alias("chi2"), F.col("wasserstein_norm").alias("score")))
    if categorical:
        parts.append(categorical_drift(counts).select(
            "column_name", F.lit("categorical").alias("kind"), none.alias("ks"),
            none.alias("wasserstein"), none.alias("wasserstein_norm"),
            "jensen_shannon", "chi2", F.col("jensen_shannon").alias("score")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("drifted", F.col("score") > threshold)


def drift_of(rows: DataFrame, numeric: list[str], categorical: list[str],
             threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """M5 over one frame whose boolean ``REF`` marks the reference rows."""
    return report_of(value_counts_by_side(rows, numeric, categorical), bool(numeric), bool(categorical), threshold)


def data_drift(reference: DataFrame, current: DataFrame, numeric: list[str], categorical: list[str],
               threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """M5 between two frames."""
    return drift_of(tagged(reference, current, [*numeric, *categorical]), numeric, categorical, threshold)


def dataset_drift(report: DataFrame, drift_share: float = 0.5, gate_share: float = DRIFT_SHARE_GATE) -> DataFrame:
    """M5 summary + M6 gate: drifted count and share; stop when the set drifts and the share > gate."""
    s = report.agg(F.count(F.lit(1)).alias("total_features"),
                   F.count_if("drifted").alias("drifted_features"))
    share = F.try_divide(F.col("drifted_features"), F.col("total_features"))
    return s.select("total_features", "drifted_features", share.alias("drift_share"),
                    (share >= drift_share).alias("dataset_drift"),
                    ((share >= drift_share) & (share > gate_share)).alias("stop"),
                    F.current_timestamp().alias("timestamp"))


def drift_gate(summary: DataFrame) -> None:
    """M6: raise when the pipeline must stop (reads the one-row summary)."""
    row = summary.first()
    if row["stop"]:
        raise RuntimeError(f"data drift: {row['drifted_features']}/{row['total_features']} columns drifted")


def top_drifted(report: DataFrame, k: int = 5) -> DataFrame:
    """The k highest drift scores (ties by column name)."""
    return report.orderBy(F.col("score").desc(), F.col("column_name")).limit(k)
