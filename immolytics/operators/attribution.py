"""Per-row feature attributions.

Interventional Shapley values by permutation sampling (Strumbelj & Kononenko,
2014), with antithetic pairs (every permutation is followed by its reverse,
Mitchell et al., 2022) or, for few features, all orders. The background is the
whole training set: each row draws ``n_draws`` background rows per pair by a
seeded hash over the numbered training rows, an equi-join. Each (row, drawn row)
is exploded into the hybrid rows of its permutations (the first k features from
the row, the rest from the background) and scored; a hybrid adds to the feature
that entered it and subtracts from the one that enters next, so one sum per row
yields all attributions: two shuffles (the draw and the sum), no window over
scored rows. Antithetic pairs are exact for models whose terms join at most two
features, all orders for any model; the draws estimate the background mean.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from itertools import permutations as orders

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..settings import RANDOM_STATE

Scorer = Callable[[DataFrame], DataFrame]
# Most features for which all orders are enumerated (720 orders).
MOST_ORDERED = 6


def permutations(features: list[str], n_pairs: int | None, seed: int = RANDOM_STATE) -> list[list[list[int]]]:
    """Groups of rank arrays (rank of feature i) that share their draws.

    ``n_pairs`` seeded pairs (pi, reverse(pi)); ``None`` gives all orders as one group.
    """
    p = len(features)
    if n_pairs is None:
        if p > MOST_ORDERED:
            raise ValueError(f"all orders of {p} features are too many; give n_pairs")
        return [[list(o) for o in orders(range(p))]]
    out = []
    for j in range(n_pairs):
        order = sorted(range(p), key=lambda i: hashlib.md5(f"{seed}|{j}|{features[i]}".encode()).hexdigest())
        rank = [0] * p
        for pos, i in enumerate(order):
            rank[i] = pos
        out.append([rank, [p - 1 - r for r in rank]])
    return out


def hashed_number(*parts: Column) -> Column:
    """A non-negative 52-bit number from the md5 of the parts joined by ``|``."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[c.cast("string") for c in parts])), 1, 13), 16, 10).cast("long")


def numbered(df: DataFrame, key: str, seed: str) -> DataFrame:
    """``_index`` 0..n-1 in the order of md5(seed|key), then key, and the row count ``_rows``.

    Rows are ranked within 4,096 hash prefixes and offset by the prefix counts
    (the only table that is gathered), so no task sorts all rows.
    """
    hashed = df.withColumn("_md5", F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"))))
    hashed = hashed.withColumn("_prefix", F.substring("_md5", 1, 3))
    w = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (hashed.groupBy("_prefix").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_from", F.coalesce(F.sum("_n").over(w), F.lit(0)))
               .withColumn("_rows", F.sum("_n").over(Window.partitionBy())).drop("_n"))
    rank = F.row_number().over(Window.partitionBy("_prefix").orderBy("_md5", key))
    return (hashed.join(F.broadcast(offsets), "_prefix")                        # 4,096 rows at most
            .withColumn("_index", F.col("_from") + rank - 1).drop("_prefix", "_md5", "_from"))


def shapley_attribution(rows: DataFrame, background: DataFrame, features: list[str], key: str,
                        scorer: Scorer, n_pairs: int | None = 1, n_draws: int = 5, seed: int = RANDOM_STATE,
                        background_key: str | None = None, errors: bool = False) -> DataFrame:
    """M9: (key, feature, phi); per row the phis add up to f(x) minus the mean of f over its draws.

    ``n_draws`` background rows are drawn per row and pair (with all orders: per
    row), uniformly from all of ``background``; ``background_key`` is its unique key.
    ``errors`` adds ``error``, the standard error of phi over a row's draws (each pair's
    mean with one background row counts as one; NULL for a single one).
    """
    p, groups = len(features), permutations(features, n_pairs, seed)
    ranks = [r for g in groups for r in g]
    per_group, steps = len(groups[0]), p + 1
    z = numbered(background.select(background_key or key, *features), background_key or key, f"{seed}-background")
    n_rows = z.select(F.max("_rows")).scalar()
    z = z.select("_index", *[F.col(f).cast("double").alias(f"z_{f}") for f in features])
    x = rows.select(key, *[F.col(f).cast("double").alias(f"x_{f}") for f in features])
    drawn = (x.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(len(groups) - 1))))
             .withColumn("_draw", F.explode(F.sequence(F.lit(0), F.lit(n_draws - 1))))
             .withColumn("_index", hashed_number(F.lit(f"{seed}-draw"), F.col(key), F.col("_group"), F.col("_draw")) % n_rows))
    pairs = drawn.join(z, "_index")
    # _step numbers (permutation, k): hybrids 0..p of every permutation of the group.
    first = F.col("_group") * (per_group * steps)
    hybrids = pairs.withColumn("_step", F.explode(F.sequence(first, first + (per_group * steps - 1))))

    def by_step(value_of) -> Column:
        return F.element_at(F.array(*[F.lit(value_of(rank, k)) for rank in ranks for k in range(steps)]),
                            F.col("_step") + 1)

    mixed = hybrids.select(key, "_group", "_draw", "_step", *[
        F.when(by_step(lambda rank, k, i=i: rank[i] < k), F.col(f"x_{f}")).otherwise(F.col(f"z_{f}")).alias(f)
        for i, f in enumerate(features)])
    scored = scorer(mixed)
    gains = [F.sum(F.col("prediction") * by_step(lambda rank, k, i=i: float((k == rank[i] + 1) - (k == rank[i]))))
             for i in range(p)]
    if not errors:
        share = 1.0 / (n_draws * len(ranks))
        sums = scored.groupBy(key).agg(*[(gain * share).alias(f) for gain, f in zip(gains, features)])
        return sums.unpivot([key], features, "feature", "phi")
    draws = scored.groupBy(key, "_group", "_draw").agg(*[(gain / per_group).alias(f) for gain, f in zip(gains, features)])
    cells = draws.groupBy(key).agg(*[F.struct(F.lit(f).alias("feature"), F.avg(f).alias("phi"),
                                              (F.stddev_samp(f) / F.sqrt(F.count(f))).alias("error")).alias(f) for f in features])
    return cells.select(key, F.inline(F.array(*[F.col(f) for f in features])))


def global_importance(phi: DataFrame) -> DataFrame:
    """Mean |phi| per feature over all explained rows."""
    return phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))


def top_attributions(phi: DataFrame, key: str, k: int = 6, wide: bool = False) -> DataFrame:
    """T4: the k features with the largest |phi| per row (ties by feature name).

    ``wide``: ``phi`` has a column per feature. Each of its rows is then cut to its own first k
    features in place, before anything is shuffled, and the features travel as numbers.
    """
    if not wide:
        w = Window.partitionBy(key).orderBy(F.abs("phi").desc(), F.col("feature"))
        return phi.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    features = sorted(c for c in phi.columns if c != key)                       # numbers in the order of the names
    if not features:
        return phi.select(key, F.lit("").alias("feature"), F.lit(0.0).alias("phi"), F.lit(0).alias("rank")).where("false")
    cells = [F.struct(F.col(f"`{f}`").isNull().alias("none"), (~F.isnan(f"`{f}`")).alias("number"), (-F.abs(f"`{f}`")).alias("size"),
                      F.lit(i).alias("at"), F.col(f"`{f}`").alias("phi")) for i, f in enumerate(features)]    # NaN first, NULL last
    first = phi.select(key, F.inline(F.slice(F.array_sort(F.array(*cells)), 1, k))).select(key, "at", "phi")
    w = Window.partitionBy(key).orderBy(F.abs("phi").desc(), F.col("at"))
    # Few rows are left to drop (those of repeated keys): no sort before the shuffle, which a plain "rank <= k" would bring.
    ranked = first.withColumn("rank", F.row_number().over(w)).where(F.least(F.col("rank"), F.lit(k + 1)) <= k)
    return ranked.select(key, F.element_at(F.array(*[F.lit(f) for f in features]), F.col("at") + 1).alias("feature"), "phi", "rank")
