"""Exact interventional Shapley values without draws.

Trees. A hybrid of an explained row x and a background row z reaches a leaf if
every feature on its path has its conditions met by the row that the feature
comes from. So a leaf adds to x's attributions by two patterns alone: which of
the path's features x meets, and which z meets. The whole background is counted
once per tree by the outcomes of the tree's conditions (a bit mask), then per
leaf by pattern; the attributions of a pattern follow from factorials. Rows look
them up by their own patterns in tables of the model's size, a batch at a time, or,
if the trees are too deep for such tables, in one join on (tree, mask). Nothing is
drawn, and every sum runs over the whole background.

Products. The Shapley values of a sum of products of few features need only the
background's mean of each part of a product: one aggregate, then arithmetic in
place.

What the driver holds is of the size of the model. Missing values fail every
condition, as Spark ML's trees do with NaN.
"""

from __future__ import annotations

import sys
from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import scratch_path

# Conditions in a word of a mask.
WORD = 62
MOST_CELLS = 100_000        # patterns of all leaves that are kept in tables
MOST_FEATURES = 8           # and features on a path: pairs of patterns grow with 4 ** features
PIECE = 100_000             # rows looked up at a time

cloudpickle.register_pickle_by_value(sys.modules[__name__])         # tasks need no copy of the package


def tree_nodes(spark: SparkSession, model) -> list[tuple]:
    """(tree, id, feature, threshold, left, right, value) of a fitted tree model; leaves have feature -1.

    ``model`` is a decision tree, random forest or gradient-boosted regressor, or a
    pipeline that ends in one; it is read from the table that Spark ML saves. The
    trees' weights are multiplied into the values.
    """
    if isinstance(model, PipelineModel):
        model = model.stages[-1]
    path = scratch_path(spark, "trees")
    model.save(path)
    saved = spark.read.parquet(f"{path}/data")
    single = "nodeData" not in saved.columns
    rows = (saved.select(F.lit(0).alias("tree"), "*") if single else saved.select(F.col("treeID").alias("tree"), "nodeData.*")).collect()
    if single:
        weights = {0: 1.0}
    elif type(model).__name__.startswith("GBT"):
        weights = dict(enumerate(model.treeWeights))
    else:
        weights = dict.fromkeys(range(model.getNumTrees), 1.0 / model.getNumTrees)
    if any(r["leftChild"] >= 0 and r["split"]["numCategories"] >= 0 for r in rows):
        raise ValueError("categorical splits are not supported: one-hot encode the features")
    return [(r["tree"], r["id"], r["split"]["featureIndex"], r["split"]["leftCategoriesOrThreshold"][0], r["leftChild"], r["rightChild"], 0.0)
            if r["leftChild"] >= 0 else (r["tree"], r["id"], -1, 0.0, -1, -1, r["prediction"] * weights[r["tree"]]) for r in rows]


def leaf_paths(nodes: list[tuple]) -> list[tuple]:
    """(tree, leaf, value, features, ones, zeros): per feature of the path the mask bits that must be 1, and those that must be 0."""
    out = []
    trees: dict[int, dict[int, tuple]] = {}
    for node in nodes:
        trees.setdefault(node[0], {})[node[1]] = node
    for tree, by_id in sorted(trees.items()):
        bit = {i: n for n, i in enumerate(sorted(i for i, node in by_id.items() if node[2] >= 0))}
        words = len(bit) // WORD + 1
        todo = [(0, {})]
        while todo:
            at, path = todo.pop()
            _, _, feature, _, left, right, value = by_id[at]
            if feature < 0:
                names = sorted(path)
                out.append((tree, len(out), value, names, [path[f][0] for f in names], [path[f][1] for f in names]))
                continue
            for child, side in ((left, 0), (right, 1)):
                sides = [list(s) for s in path.get(feature, ([0] * words, [0] * words))]
                sides[side][bit[at] // WORD] |= 1 << (bit[at] % WORD)
                todo.append((child, {**path, feature: tuple(sides)}))
    return out


def masks(rows: DataFrame, nodes: list[tuple], features: list[str], *keep: str) -> DataFrame:
    """(keep, tree, mask): per row and tree the outcomes of the tree's conditions, a bit each."""
    inner: dict[int, list[tuple]] = {}
    for node in sorted(nodes):
        inner.setdefault(node[0], [])
        if node[2] >= 0:
            inner[node[0]].append(node)
    cells = []
    for tree, conditions in inner.items():
        words = []
        for at in range(0, len(conditions) // WORD * WORD + 1, WORD):
            word = F.lit(0).cast("long")
            for i, (_, _, feature, threshold, *_) in enumerate(conditions[at:at + WORD]):
                value = F.col(features[feature]).cast("double")
                word = word.bitwiseOR(F.when(F.coalesce(value <= threshold, F.lit(False)), F.lit(1 << i).cast("long")).otherwise(0))
            words.append(word)
        cells.append(F.struct(F.lit(tree).alias("tree"), F.array(*words).alias("mask")))
    return rows.select(*keep, F.inline(F.array(*cells)))


def _pattern() -> Column:
    """Bit k: the mask meets the conditions of the path's k-th feature."""
    def met(k):
        ones, zeros = F.col("ones")[k], F.col("zeros")[k]
        return F.forall(F.sequence(F.lit(0), F.size("mask") - 1), lambda w: (F.col("mask")[w].bitwiseAND(ones[w]) == ones[w])
                        & (F.col("mask")[w].bitwiseAND(zeros[w]) == 0))
    places = F.when(F.size("features") > 0, F.sequence(F.lit(0), F.size("features") - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, F.lit(0).cast("long"), lambda total, k: total + F.when(met(k), F.call_function(
        "shiftleft", F.lit(1).cast("long"), k)).otherwise(0))


# ------------------------------------------------------------------ trees whose patterns fit into tables
def tables_of(nodes: list[tuple]) -> list[tuple] | None:
    """Per tree: its conditions (feature, threshold, bit), and its leaves (value, features, ones, zeros, first cell of its patterns).

    None if a tree has more conditions than a word, or the patterns of all leaves are too many for a table of the driver.
    """
    leaves, inner, first, out = leaf_paths(nodes), {}, 0, []
    for node in sorted(nodes):
        inner.setdefault(node[0], []).extend([node] if node[2] >= 0 else [])
    if max(map(len, inner.values())) > WORD or sum(2.0 ** len(leaf[3]) for leaf in leaves) > MOST_CELLS or any(
            len(leaf[3]) > MOST_FEATURES for leaf in leaves):
        return None
    for tree, conditions in inner.items():
        own = []
        for _, _, value, names, ones, zeros in (leaf for leaf in leaves if leaf[0] == tree):
            own.append((value, names, [o[0] for o in ones], [z[0] for z in zeros], first))
            first += 2 ** len(names)
        out.append(([(f, threshold, bit) for bit, (_, _, f, threshold, *_) in enumerate(conditions)], own))
    return out


def distinct_masks(trees: list[tuple], n_features: int):
    """Columns -> per tree the number of each row's mask among the distinct ones, and these."""
    cuts = [np.unique([t for conditions, _ in trees for g, t, _ in conditions if g == f]) for f in range(n_features)]
    words = []
    for conditions, _ in trees:
        of_feature = {}
        for f, threshold, bit in conditions:
            met = (np.arange(len(cuts[f]) + 1) <= np.searchsorted(cuts[f], threshold)).astype("i8") << bit
            of_feature[f] = of_feature.get(f, 0) | met
        words.append(of_feature)

    def run(x: list[np.ndarray]):
        n = len(x[0])
        bins = {f: np.searchsorted(cuts[f], x[f]) for f in range(n_features) if len(cuts[f])}       # missing values beyond the last
        for of_feature in words:
            mask = np.zeros(n, "i8")
            for f, word in of_feature.items():
                mask |= word.take(bins[f])
            yield pd.factorize(mask)
    return run


def patterns(leaf: tuple, masks: np.ndarray) -> np.ndarray:
    """Bit k: the mask meets the conditions of the path's k-th feature."""
    out = np.zeros(len(masks), np.intp)
    for k, (ones, zeros) in enumerate(zip(leaf[2], leaf[3])):
        out |= ((masks & (ones | zeros)) == ones).astype(np.intp) << k
    return out


def in_pieces(batches, n_columns: int):
    """Arrow batches joined to pieces of about ``PIECE`` rows: lists of arrays."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= PIECE:
            yield [pa.concat_arrays([b.column(i) for b in held]) for i in range(n_columns)]
            held, n = [], 0
    if held:
        yield [pa.concat_arrays([b.column(i) for b in held]) for i in range(n_columns)]


def _doubles(features: list[str]) -> list[Column]:
    return [F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)]


def _floats(columns: list[pa.Array]) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False).astype("f8", copy=False) for c in columns]


def pattern_counts(background: DataFrame, trees: list[tuple], features: list[str]) -> tuple[int, np.ndarray]:
    """Number of rows of the whole ``background``, and how many have each pattern of each leaf (one cell each)."""
    n_cells = sum(2 ** len(leaf[1]) for _, leaves in trees for leaf in leaves)

    def run(batches):
        masks_of, cells, n_rows = distinct_masks(trees, len(features)), np.zeros(n_cells), 0
        for columns in in_pieces(batches, len(features)):
            n_rows += len(columns[0])
            for (_, leaves), (numbers, found) in zip(trees, masks_of(_floats(columns))):
                n = np.bincount(numbers, minlength=len(found))
                for leaf in leaves:
                    size = 2 ** len(leaf[1])
                    cells[leaf[4]:leaf[4] + size] += np.bincount(patterns(leaf, found), n, minlength=size)
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(cells[at], n_rows).astype("i8"))], ["cell", "n"])

    counts = background.select(*_doubles(features)).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out, n_rows = np.zeros(n_cells), 0
    for cell, n in counts:
        if cell < 0:
            n_rows = n
        else:
            out[cell] = n
    return n_rows, out


def gains_of(leaf: tuple, counts: np.ndarray) -> np.ndarray:
    """What a leaf adds to its features (columns) by the pattern of x (rows), given the number of background rows by pattern."""
    value, names, _, _, first = leaf
    k = len(names)
    n, full = counts[first:first + 2 ** k], 2 ** k - 1
    out = np.zeros((2 ** k, k))
    z = np.flatnonzero(n)
    for x in range(2 ** k):
        # Features that only x meets must come from x, those that only z meets from z; those that neither meets close the leaf.
        for m in z[((z | x) == full) & (z != x)].tolist():
            u, v = (x & ~m).bit_count(), (m & ~x).bit_count()
            for j in range(k):
                if x >> j & 1 and not m >> j & 1:
                    out[x, j] += value * n[m] * factorial(u - 1) * factorial(v) / factorial(u + v)
                elif m >> j & 1 and not x >> j & 1:
                    out[x, j] -= value * n[m] * factorial(v - 1) * factorial(u) / factorial(u + v)
    return out


def _by_tables(rows: DataFrame, background: DataFrame, trees: list[tuple], features: list[str], key: str) -> DataFrame:
    """``tree_attribution`` of trees whose patterns fit into tables: rows are looked up where they are."""
    n_rows, counts = pattern_counts(background, trees, features)
    gains = [[gains_of(leaf, counts) for leaf in leaves] for _, leaves in trees]
    used = sorted({f for _, leaves in trees for leaf in leaves for f in leaf[1]})
    place = {f: i for i, f in enumerate(used)}

    def run(batches):
        masks_of = distinct_masks(trees, len(features))
        for keys, *columns in in_pieces(batches, len(features) + 1):
            out = np.zeros((len(keys), len(used)))
            for (_, leaves), own, (numbers, found) in zip(trees, gains, masks_of(_floats(columns))):
                phi = np.zeros((len(found), len(used)))
                for leaf, gain in zip(leaves, own):
                    of_leaf = gain.take(patterns(leaf, found), axis=0)
                    for k, f in enumerate(leaf[1]):
                        phi[:, place[f]] += of_leaf[:, k]
                out += phi.take(numbers, axis=0)
            yield pa.RecordBatch.from_arrays([keys, *[pa.array(out[:, i]) for i in range(len(used))]], ["key", *[f"phi_{f}" for f in used]])

    plain = T.StructType([T.StructField("key", rows.schema[key].dataType), *[T.StructField(f"phi_{f}", T.DoubleType()) for f in used]])
    mine = rows.select(F.col(key).alias("key"), *_doubles(features)).mapInArrow(run, plain)
    sums = mine.groupBy(F.col("key").alias(key)).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(f"phi_{f}").alias(f"phi_{f}") for f in used])
    return sums.select(key, *[((F.col(f"phi_{i}") if i in place else F.lit(0.0)) / F.lit(float(n_rows))).alias(f)
                              for i, f in enumerate(features)]).unpivot([key], features, "feature", "phi")


def tree_attribution(rows: DataFrame, background: DataFrame, nodes: list[tuple], features: list[str], key: str) -> DataFrame:
    """M9: (key, feature, phi); per row the phis add up to f(x) minus the mean of f over the whole ``background``."""
    trees = tables_of(nodes)
    if trees:
        return _by_tables(rows, background, trees, features, key)
    spark = rows.sparkSession
    leaves = leaf_paths(nodes)
    deepest = max((len(leaf[3]) for leaf in leaves), default=0)
    table = F.broadcast(spark.createDataFrame(leaves, "tree int, leaf int, value double, features array<int>, ones array<array<long>>, "
                                                      "zeros array<array<long>>"))                      # of the model's size
    mine = masks(rows, nodes, features, key)
    cells = mine.select("tree", "mask").distinct().join(table, "tree").withColumn("x", _pattern())
    counts = masks(background, nodes, features).groupBy("tree", "mask").agg(F.count(F.lit(1)).alias("n"))
    n_rows = background.agg(F.count(F.lit(1)).cast("double")).scalar()
    met = counts.join(table, "tree").withColumn("z", _pattern()).groupBy("leaf", "z").agg(F.sum("n").alias("n"))

    # Features that only x meets must come from x, those that only z meets from z; those that neither meets close the leaf.
    pairs = cells.select("leaf", "value", "features", "x").distinct().join(met, "leaf")
    full = F.call_function("shiftleft", F.lit(1).cast("long"), F.size("features")) - 1
    pairs = pairs.where((F.col("x").bitwiseOR(F.col("z")) == full) & (F.col("x") != F.col("z")))
    pairs = pairs.withColumn("u", F.bit_count(F.col("x").bitwiseAND(F.bitwise_not("z")))).withColumn(
        "v", F.bit_count(F.col("z").bitwiseAND(F.bitwise_not("x"))))

    def share(own: str, other: str) -> Column:
        """(own - 1)! other! / (own + other)!"""
        size = deepest + 1
        values = [float(factorial(max(0, u - 1)) * factorial(v)) / factorial(u + v) for u in range(size) for v in range(size)]
        return F.element_at(F.array(*[F.lit(x) for x in values]), F.col(own) * size + F.col(other) + 1)

    weighted = pairs.withColumn("for_x", F.col("value") * F.col("n") * share("u", "v")).withColumn(
        "for_z", -F.col("value") * F.col("n") * share("v", "u"))
    of_feature = weighted.select("leaf", "x", "z", "for_x", "for_z", F.posexplode("features").alias("k", "feature"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("k"))
    has_x, has_z = F.col("x").bitwiseAND(bit) != 0, F.col("z").bitwiseAND(bit) != 0
    gain = F.when(has_x & ~has_z, F.col("for_x")).when(has_z & ~has_x, F.col("for_z")).otherwise(0.0)
    of_pattern = of_feature.groupBy("leaf", "x", "feature").agg(F.sum(gain).alias("phi"))
    of_cell = (cells.select("tree", "mask", "leaf", "x").join(of_pattern, ["leaf", "x"]).groupBy("tree", "mask").agg(
        *[F.sum(F.when(F.col("feature") == i, F.col("phi")).otherwise(0.0)).alias(f"phi_{i}") for i in range(len(features))]))
    sums = mine.join(of_cell, ["tree", "mask"], "left").groupBy(key).agg(
        *[(F.coalesce(F.sum(f"phi_{i}"), F.lit(0.0)) / n_rows).alias(f) for i, f in enumerate(features)])
    return sums.unpivot([key], features, "feature", "phi")


def expected_value(background: DataFrame, nodes: list[tuple], features: list[str]) -> Column:
    """The mean of the trees' sum over ``background``, what a row's phis start from."""
    trees = tables_of(nodes)
    if trees:
        n_rows, n = pattern_counts(background, trees, features)
        total = sum(value * n[first + 2 ** len(names) - 1] for _, leaves in trees for value, names, _, _, first in leaves)
        return F.lit(float(total / n_rows) if n_rows else None).cast("double")
    spark = background.sparkSession
    table = F.broadcast(spark.createDataFrame(leaf_paths(nodes), "tree int, leaf int, value double, features array<int>, "
                                              "ones array<array<long>>, zeros array<array<long>>"))
    counts = masks(background, nodes, features).groupBy("tree", "mask").agg(F.count(F.lit(1)).alias("n"))
    full = F.call_function("shiftleft", F.lit(1).cast("long"), F.size("features")) - 1
    hit = counts.join(table, "tree").withColumn("z", _pattern()).where(F.col("z") == full)
    one = F.sum(F.when(F.col("tree") == min(n[0] for n in nodes), F.col("n")))
    return hit.agg(F.sum(F.col("value") * F.col("n")) / one).scalar()


def product_attribution(rows: DataFrame, background: DataFrame, terms: list[tuple[float, tuple[str, ...]]], features: list[str],
                        key: str, wide: bool = False) -> DataFrame:
    """M9 for a sum of products, ``terms`` as (factor, features): exact over the whole ``background``, from its means.

    ``wide`` gives a row per explained row with a column per feature in place of (key, feature, phi).
    """
    parts = sorted({part for _, names in terms for size in range(1, len(names) + 1) for part in combinations(names, size)})

    def product(names) -> Column:
        out = F.lit(1.0)
        for name in names:
            out = out * F.col(name).cast("double")
        return out

    means = background.agg(*[F.avg(product(part)).alias(f"m{i}") for i, part in enumerate(parts)])
    mean = {(): F.lit(1.0), **{part: means.select(f"m{i}").scalar() for i, part in enumerate(parts)}}
    values = {f: F.lit(0.0) for f in features}
    for factor, names in terms:
        m = len(names)
        for j in names:
            others = [n for n in names if n != j]
            for size in range(m):
                weight = factor * factorial(size) * factorial(m - size - 1) / factorial(m)
                for chosen in combinations(others, size):
                    rest = tuple(n for n in names if n not in chosen and n != j)
                    with_j = tuple(n for n in names if n not in chosen)
                    gain = product((*chosen, j)) * mean[rest] - product(chosen) * mean[with_j]
                    values[j] = values[j] + F.lit(weight) * gain
    out = rows.select(key, *[v.alias(f) for f, v in values.items()])
    return out if wide else out.unpivot([key], features, "feature", "phi")
