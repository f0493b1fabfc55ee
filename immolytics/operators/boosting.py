"""Gradient-boosted trees over many rows (M1): histograms of binned blocks.

Spark ML's booster keeps every row as objects (about 300 bytes with its errors) and
walks them one by one. Here the rows are binned once into blocks of 32,768: features
with few bins share one 16-bit code (their joint bin), so a row is a few codes and
its residual, about 16 bytes. A level of a tree is one job: each task counts its
blocks into histograms (of two siblings only the smaller), which the driver adds up
(their size is that of the model's bins) to choose the splits. Parameters, losses and split rules are those of
``GBTRegressor``, and so is the fitted model, a ``GBTRegressionModel``: squared
error, a first tree of weight 1, rows drawn per tree without replacement. As there, a
null, NaN or infinite label or feature is an error. Bins come from quantiles of all rows.
"""

from __future__ import annotations

import math
import sys
import uuid
from collections import namedtuple
from typing import Iterator, Tuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, cloudpickle
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

ROWS = 32_768               # rows in a block
PART_ROWS = 4_000_000       # most rows in a task, which holds one block at a time
CELLS = 1_024               # joint bins of the features that share a code
QUANTILES = 1_000
DEEPEST = 8                 # histograms grow with 2 ** depth
TOP = 4                     # levels whose conditions fit into a 16-bit mask
FRESH = 25                  # trees after which residuals are computed from the first blocks again
LABEL_ERROR, FEATURE_ERROR = "Labels MUST NOT be Null, NaN or Infinity", "Vector values MUST NOT be NaN or Infinity"
PARAMS = {"maxIter", "maxDepth", "stepSize", "minInstancesPerNode", "subsamplingRate", "seed", "maxBins", "minInfoGain"}

Params = namedtuple("Params", "trees depth rate step least gain seed")

cloudpickle.register_pickle_by_value(sys.modules[__name__])         # tasks need no copy of the package


def supports(train: DataFrame, features: list[str], params: dict) -> bool:
    """True if the blocks can hold such features and the booster knows all ``params``."""
    fields = {f.name: f for f in train.schema}
    plain = all(isinstance(fields[c].dataType, (T.NumericType, T.BooleanType)) and "ml_attr" not in fields[c].metadata for c in features)
    gbt = GBTRegressor(**params)
    return plain and set(params) <= PARAMS and gbt.getMaxDepth() <= DEEPEST and gbt.getMaxBins() <= 256


# ------------------------------------------------------------------ bins and blocks
def numbers(column: pa.Array, message: str) -> np.ndarray:
    x = column.to_numpy(zero_copy_only=False).astype("f8")
    if not np.isfinite(x).all():
        raise ValueError(message)
    return x


def quantiles(points: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """``QUANTILES`` + 1 values at even shares of the (weighted) points, least and greatest included."""
    order = np.argsort(points, kind="stable") if weights is not None else None
    points = points[order] if order is not None else np.sort(points)
    shares = np.linspace(0, 1, QUANTILES + 1)
    if order is None:
        return points[np.round(shares * (len(points) - 1)).astype(int)]
    sums = np.cumsum(weights[order])
    at = np.searchsorted(sums, shares * sums[-1]).clip(max=len(points) - 1)
    at[0], at[-1] = 0, len(points) - 1
    return points[at]


def merged(parts: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """One table (features, quantiles) from those of several sets of rows."""
    weights = np.concatenate([np.full(QUANTILES + 1, float(n)) for n, _ in parts])
    return np.stack([quantiles(np.concatenate([table[f] for _, table in parts]), weights) for f in range(len(parts[0][1]))])


def all_quantiles(rows: DataFrame, n_features: int) -> tuple[int, np.ndarray]:
    """Number of rows and the features' quantiles: per block, merged per task, then over the tasks."""
    def run(batches):
        held, blocks = [], []
        for batch in batches:
            if batch.num_rows:
                held.append([numbers(batch.column(f), FEATURE_ERROR) for f in range(n_features)])
            if sum(len(h[0]) for h in held) >= 4 * ROWS:
                blocks.append(table(held))
                held = []
        if held:
            blocks.append(table(held))
        if blocks:
            yield pa.RecordBatch.from_arrays([pa.array([sum(n for n, _ in blocks)]), pa.array([merged(blocks).tobytes()], pa.binary())], ["n", "found"])

    def table(held):
        return sum(len(h[0]) for h in held), np.stack([quantiles(np.concatenate([h[f] for h in held])) for f in range(n_features)])

    found = [(r[0], np.frombuffer(r[1]).reshape(n_features, -1)) for r in rows.mapInArrow(run, "n long, found binary").collect()]
    return sum(n for n, _ in found), merged(found)


def bin_cuts(tables: np.ndarray, bins: int) -> list[np.ndarray]:
    """Ascending thresholds per feature, halfway between neighbouring values: at most ``bins`` - 1."""
    out = []
    for found in tables:
        values = np.unique(found)
        last = np.arange(len(values) - 1)                               # the values after which a cut lies
        if len(values) > bins:
            chosen = np.unique(found[np.arange(1, bins) * QUANTILES // bins])
            last = np.searchsorted(values, chosen[chosen < values[-1]])
        low, high = values[last], values[last + 1]
        middle = low + (high - low) / 2
        out.append(np.where(middle < high, middle, low))
    return out


def shared_codes(sizes: list[int]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """First fit of features (numbers of bins) into codes: code and step of each feature, joint bins of each code."""
    code, step, cells = np.zeros(len(sizes), int), np.ones(len(sizes), int), []
    for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
        at = next((p for p, c in enumerate(cells) if c * sizes[f] <= CELLS), len(cells))
        if at == len(cells):
            cells.append(1)
        code[f], step[f] = at, cells[at]
        cells[at] *= sizes[f]
    return code, step, cells


def to_blocks(cuts: list[np.ndarray], code, step, n_codes: int):
    """Arrow batches (x0.., y) -> one row (id, codes, residuals) per block."""
    def block(number: int, codes: list, labels: list) -> pa.RecordBatch:
        ident = TaskContext.get().partitionId() << 32 | number
        return pa.RecordBatch.from_arrays(
            [pa.array([ident]), pa.array([np.concatenate(codes, axis=1).tobytes()], pa.binary()),
             pa.array([np.concatenate(labels).tobytes()], pa.binary())], ["id", "codes", "residuals"])

    def run(batches):
        number, codes, labels, held = 0, [], [], 0
        for batch in batches:
            n = batch.num_rows
            y = numbers(batch.column(len(cuts)), LABEL_ERROR)
            packed = np.zeros((n_codes, n), "i2")
            for f, cut in enumerate(cuts):
                x = numbers(batch.column(f), FEATURE_ERROR)
                packed[code[f]] += (np.searchsorted(cut, x) * step[f]).astype("i2")
            codes.append(packed)
            labels.append(y)
            held += n
            if held >= ROWS:
                yield block(number, codes, labels)
                number, codes, labels, held = number + 1, [], [], 0
        if held:
            yield block(number, codes, labels)
    return run


# ------------------------------------------------------------------ work on blocks
def places(levels: list[tuple], cells: list[int]):
    """Codes -> place of each row among the nodes below ``levels``; a level is (code, step, bins, cut) per node.

    A code's cell meets or fails the conditions of the first levels at once: a look-up per code gives their
    outcomes as bits, and one more the place that these lead to. Deeper levels are walked one by one.
    """
    tables, widest, bit = {}, max(cells), 0
    for code, step, bins, cut in levels[:TOP]:
        for c, s, b, k in zip(code.tolist(), step, bins, cut):
            if k < b:                                                   # others lead left all rows
                outcome = np.arange(cells[c]) // s % b > k
                tables[c] = tables.get(c, np.zeros(cells[c], "u2")) | (outcome.astype("u2") << bit).astype("u2")
            bit += 1
    mask, place_of = np.arange(2 ** bit), np.zeros(2 ** bit, int)
    for level in range(min(len(levels), TOP)):
        place_of = 2 * place_of + (mask >> (2 ** level - 1 + place_of) & 1)
    place_of = place_of.astype("u1")
    deep = [(code, ((np.arange(widest) // step[:, None] % bins[:, None]) > cut[:, None]).astype(np.intp).reshape(-1))
            for code, step, bins, cut in levels[TOP:]]

    def find(codes: np.ndarray) -> np.ndarray:
        n, mask = codes.shape[1], None
        for c, table in tables.items():
            met = table.take(codes[c].astype(np.intp))
            mask = met if mask is None else np.bitwise_or(mask, met, out=mask)
        place = np.zeros(n, "u1") if mask is None else place_of.take(mask.astype(np.intp))
        if deep:
            flat, at, place = codes.reshape(-1), np.arange(n), place.astype(np.intp)
        for code, right in deep:
            cell = flat.take((code * n).take(place) + at)
            place = 2 * place + right.take(place * widest + cell)
        return place
    return find


def left_out(rate: float, seed: tuple[int, int], ident: int, n: int) -> np.ndarray | None:
    """The rows of a block that a tree does not see."""
    return np.random.default_rng((*seed, ident)).random(n) >= rate if rate < 1 else None


def mover(trees: list[tuple], cells: list[int], rate: float, last: tuple[int, int], seed: tuple[int, int]):
    """Blocks -> blocks whose residuals are lowered by the predictions of ``trees`` (levels, values), with the rows left out for the
    tree ``seed`` and, per leaf of the tree before (``last``), the sum of squares of what it was fitted to."""
    def run(part):
        finds = [(places(levels, cells), values) for levels, values in trees]
        for ident, codes, residuals, *_ in part:
            residuals = residuals.copy()
            for k, (find, values) in enumerate(finds):
                place = find(codes).astype(np.intp)
                if k == len(finds) - 1:
                    square, out = residuals * residuals, left_out(rate, last, ident, len(residuals))
                    if out is not None:
                        square[out] = 0.0
                    squares = np.bincount(place, square, minlength=len(values))
                residuals -= values.take(place)
            out = left_out(rate, seed, ident, len(residuals))
            yield ident, codes, residuals, None if out is None else np.packbits(out), squares
    return run


def counter(levels: list[tuple], chosen: list[int], code, step, sizes: list[int], cells: list[int], n_squares: int):
    """Blocks -> number of rows and sum of residuals per ``chosen`` node and bin (those of all features side by side), then
    the blocks' squares, as one array."""
    n_chosen, none = len(chosen), 255

    def count(part):
        find = places(levels, cells)
        slot = np.full(2 ** len(levels), none, "u1")
        slot[chosen] = np.arange(n_chosen)
        sums, squares = [np.zeros((2, n_chosen * c)) for c in cells], np.zeros(n_squares)
        for _, codes, residuals, out, square in part:
            at = slot.take(find(codes).astype(np.intp))
            if out is not None:
                at |= np.unpackbits(out, count=len(at)) * np.uint8(none)
            rows = np.flatnonzero(at != none)
            node, residuals = at.take(rows).astype(np.intp), residuals.take(rows)
            for p, c in enumerate(cells):
                cell = node * c
                cell += codes[p].take(rows)
                sums[p][0] += np.bincount(cell, minlength=n_chosen * c)
                sums[p][1] += np.bincount(cell, residuals, minlength=n_chosen * c)
            if square is not None:
                squares[:len(square)] += square
        single = [sums[p].reshape(2, n_chosen, -1, b, s).sum(axis=(2, 4)) for p, s, b in zip(code, step, sizes)]
        yield np.concatenate([np.concatenate(single, axis=2).reshape(-1), squares])

    return count


# ------------------------------------------------------------------ trees
def best_splits(hist: np.ndarray, sizes: list[int], least: int):
    """Per node: feature, last bin on the left, gain, and the statistics of the node and of its two sides."""
    feature = np.repeat(np.arange(len(sizes)), [b - 1 for b in sizes])
    cut = np.concatenate([np.arange(b - 1) for b in sizes])
    starts = np.cumsum([0, *sizes])
    total = hist[:, :, :sizes[0]].sum(axis=2)
    if not len(feature):
        return None, None, np.full(total.shape[1], -np.inf), total, None, None
    left = np.concatenate([hist[:, :, a:a + b].cumsum(axis=2)[:, :, :-1] for a, b in zip(starts, sizes)], axis=2)
    right = total[:, :, None] - left
    with np.errstate(all="ignore"):
        gain = (left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - (total[1] ** 2 / total[0])[:, None]) / total[0][:, None]
    gain = np.where((left[0] >= max(least, 1)) & (right[0] >= max(least, 1)), gain, -np.inf)
    k = gain.argmax(axis=1)
    own = np.arange(len(k))
    return feature[k], cut[k], gain[own, k], total, left[:, own, k], right[:, own, k]


def grow(count, params: Params, code, step, sizes: list[int]) -> tuple[list[tuple], dict]:
    """One tree: its levels, and its nodes {(level, place): (statistics, split or None)}.

    ``count(levels, chosen)`` gives the histograms of the chosen nodes. Of two siblings only the one with
    fewer rows is counted, the other is what their parent has besides.
    """
    levels, nodes, hist, alive = [], {}, {}, [0]
    for level in range(params.depth):
        if level == 0:
            hist = {0: count(levels, [0])[:, 0]}
        else:
            fewer = [min((2 * i, 2 * i + 1), key=lambda c: nodes[level, c][0][0]) for i in alive]
            counted, above = count(levels, fewer), hist
            hist = {}
            for k, (i, c) in enumerate(zip(alive, fewer)):
                other = above[i] - counted[:, k]
                other[1, other[0] == 0] = 0.0                           # no rows, no rest of a rounding
                hist[c], hist[c ^ 1] = counted[:, k], other
        own = sorted(hist)
        feature, cut, gain, total, left, right = best_splits(np.stack([hist[i] for i in own], axis=1), sizes, params.least)
        if level == 0:
            nodes[0, 0] = (total[:, 0], None)
        alive = [i for k, i in enumerate(own) if gain[k] > 0 and gain[k] >= params.gain]
        if not alive:
            break
        features, cuts = np.zeros(2 ** level, int), np.full(2 ** level, max(sizes))
        for k, i in enumerate(own):
            if i in alive:
                nodes[level, i] = (nodes[level, i][0], (feature[k], cut[k], gain[k]))
                nodes[level + 1, 2 * i], nodes[level + 1, 2 * i + 1] = (left[:, k], None), (right[:, k], None)
                features[i], cuts[i] = feature[k], cut[k]
        levels.append((code[features], step[features], np.asarray(sizes)[features], cuts))
    if not nodes:                                                       # depth 0
        nodes[0, 0] = (best_splits(count([], [0]), sizes, 1)[3][:, 0], None)
    return levels, nodes


def with_squares(nodes: dict, n_levels: int, squares: np.ndarray) -> dict:
    """Nodes whose statistics end with the sum of squares, given that of each leaf's place."""
    out = {}
    for (level, i), (stats, split) in sorted(nodes.items(), reverse=True):
        total = squares[i << (n_levels - level)] if split is None else sum(out[level + 1, c][0][2] for c in (2 * i, 2 * i + 1))
        out[level, i] = (np.append(stats, total), split)
    return out


def mean(stats: np.ndarray) -> float:
    return float(stats[1] / stats[0]) if stats[0] else 0.0


def leaf_values(levels: list[tuple], nodes: dict) -> np.ndarray:
    values = np.zeros(2 ** len(levels))
    for (level, i), (stats, split) in nodes.items():
        if split is None:                                               # rows of an early leaf go left to the end
            values[i << (len(levels) - level)] = mean(stats)
    return values


def boosted(blocks: DataFrame, params: Params, code, step, sizes: list[int], cells: list[int]) -> tuple[list[dict], list[float]]:
    """All trees and their weights: a job per level."""
    def arrays(row):
        residuals = np.frombuffer(row[2])
        out = left_out(params.rate, (params.seed, 0), row[0], len(residuals))
        return row[0], np.frombuffer(row[1], "i2").reshape(len(cells), -1), residuals, None if out is None else np.packbits(out), None

    first = blocks.rdd.map(arrays).persist(StorageLevel.DISK_ONLY)
    held, trees, moves, weights, n_squares = [first], [], [], [], 2 ** params.depth         # the first blocks, those before and those now

    def advance(t: int) -> None:                                        # residuals after the tree before; few maps behind each
        whole = t % FRESH == 0
        run = mover(moves if whole else moves[-1:], cells, params.rate, (params.seed, t - 1), (params.seed, t))
        held.append((first if whole else held[-1]).mapPartitions(run).persist(StorageLevel.MEMORY_AND_DISK_DESER))

    def found(levels, chosen) -> np.ndarray:
        out = held[-1].mapPartitions(counter(levels, chosen, code, step, sizes, cells, n_squares)).treeReduce(
            np.add, 1 if first.getNumPartitions() <= 256 else 2)
        while len(held) > 2:
            held.pop(1).unpersist()
        return out

    def settle(t: int, squares: np.ndarray) -> None:
        trees[t] = with_squares(trees[t], len(moves[t][0]), squares * (4.0 if t else 1.0))

    try:
        for t in range(params.trees):
            if t:
                advance(t)
            scale = np.array([1.0, 2.0 if t else 1.0])[:, None, None]   # the gradient of the squared error

            def count(levels, chosen):
                out = found(levels, chosen)
                if t and not levels:
                    settle(t - 1, out[-n_squares:])
                return out[:-n_squares].reshape(2, len(chosen), sum(sizes)) * scale

            levels, nodes = grow(count, params, code, step, sizes)
            weights.append(params.step if t else 1.0)
            trees.append(nodes)
            moves.append((levels, weights[-1] * leaf_values(levels, nodes)))
        advance(params.trees)
        settle(params.trees - 1, found([], [0])[-n_squares:])
        return trees, weights
    finally:
        for rdd in held:
            rdd.unpersist()


def to_model(spark: SparkSession, gbt: GBTRegressor, trees: list[dict], weights: list[float], cuts: list[np.ndarray]) -> GBTRegressionModel:
    """The trees as Spark ML's model."""
    jvm, new_array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    ml, mllib = jvm.org.apache.spark.ml, jvm.org.apache.spark.mllib

    def doubles(values):
        out = new_array(jvm.double, len(values))
        for i, v in enumerate(values):
            out[i] = float(v)
        return out

    def node(nodes: dict, level: int, i: int):
        stats, split = nodes[level, i]
        about = mllib.tree.impurity.VarianceCalculator(doubles(stats), int(stats[0]))
        impurity = max(float(stats[2] / stats[0] - mean(stats) ** 2), 0.0) if stats[0] else 0.0
        if split is None:
            return ml.tree.LeafNode(mean(stats), impurity, about)
        f, cut, gain = split
        return ml.tree.InternalNode(mean(stats), impurity, float(gain), node(nodes, level + 1, 2 * i), node(nodes, level + 1, 2 * i + 1),
                                    ml.tree.ContinuousSplit(int(f), float(cuts[f][cut])), about)

    found = new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    for t, nodes in enumerate(trees):
        found[t] = ml.regression.DecisionTreeRegressionModel(f"dtr_{uuid.uuid4().hex[:12]}", node(nodes, 0, 0), len(cuts))
    model = GBTRegressionModel(ml.regression.GBTRegressionModel(gbt.uid, found, doubles(weights), len(cuts)))
    return gbt._copyValues(model)


def fit(gbt: GBTRegressor, train: DataFrame, features: list[str]) -> GBTRegressionModel:
    """``gbt`` fitted on all rows of ``train``."""
    spark = train.sparkSession
    rows = train.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)],
                        F.col(f"`{gbt.getLabelCol()}`").cast("double").alias("y"))
    n, tables = all_quantiles(rows, len(features))
    cuts = bin_cuts(tables, gbt.getMaxBins())
    sizes = [len(c) + 1 for c in cuts]
    code, step, cells = shared_codes(sizes)
    params = Params(gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getSubsamplingRate(), gbt.getStepSize(), gbt.getMinInstancesPerNode(),
                    gbt.getMinInfoGain(), gbt.getSeed() & (2 ** 63 - 1))
    cores = spark.sparkContext.defaultParallelism
    blocks = (rows.mapInArrow(to_blocks(cuts, code, step, len(cells)), "id long, codes binary, residuals binary")
              .repartition(math.ceil(n / PART_ROWS / cores) * cores))
    trees, weights = boosted(blocks, params, code, step, sizes, cells)
    return to_model(spark, gbt, trees, weights, cuts)


# ------------------------------------------------------------------ scores
def as_levels(own: list[tuple], cuts: list[np.ndarray], code, step) -> tuple[list[tuple], np.ndarray]:
    """A tree's nodes as the levels and leaf values of ``places``."""
    by_id, row, levels = {n[1]: n for n in own}, [own[0]], []
    while any(n[2] >= 0 for n in row):
        feature = np.array([max(n[2], 0) for n in row])
        cut = np.array([np.searchsorted(cuts[n[2]], n[3]) if n[2] >= 0 else 2 ** 15 for n in row])          # a leaf's rows go left
        levels.append((code[feature], step[feature], np.array([len(cuts[f]) + 1 for f in feature]), cut))
        row = [c for n in row for c in ((by_id[n[4]], by_id[n[5]]) if n[2] >= 0 else (n, n))]
    return levels, np.array([n[6] for n in row])


def depth(own: list[tuple]) -> int:
    by_id, row, out = {n[1]: n for n in own}, [own[0]], 0
    while row := [by_id[c] for n in row if n[2] >= 0 for c in n[4:6]]:
        out += 1
    return out


def prediction(nodes: list[tuple], features: list[str]) -> Column:
    """The sum of the trees ``nodes`` (``tree_attribution.tree_nodes``) as a column, a batch of rows at a time.

    Rows are binned at the trees' own thresholds and found in each tree as in the blocks; deep trees are walked node by node.
    """
    trees = [sorted((n for n in nodes if n[0] == tree), key=lambda n: n[1]) for tree in sorted({n[0] for n in nodes})]
    cuts = [np.unique([n[3] for n in nodes if n[2] == f]) for f in range(len(features))]
    sizes = [len(c) + 1 for c in cuts]
    binned = max(sizes) <= 2 ** 15 - 1 and max(map(depth, trees)) <= DEEPEST
    code, step, cells = shared_codes(sizes)

    def walk(own: list[tuple]):
        at = {n[1]: i for i, n in enumerate(own)}
        children = np.array([(at.get(n[4], i), at.get(n[5], i)) for i, n in enumerate(own)], np.intp).reshape(-1)           # a leaf leads to itself
        feature, threshold, value = np.array([max(n[2], 0) for n in own]), np.array([n[3] for n in own]), np.array([n[6] for n in own])

        def find(x: list[np.ndarray]) -> np.ndarray:
            n, flat = len(x[0]), np.concatenate(x)
            rows, place = np.arange(n), np.zeros(n, np.intp)
            while True:                                                 # missing values go right, as in Spark ML
                below = children.take(2 * place + ~(flat.take(feature.take(place) * n + rows) <= threshold.take(place)))
                if (below == place).all():
                    return place
                place = below
        return find, value

    def packed(x: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(cells), len(x[0])), "i2")
        for f, cut in enumerate(cuts):
            if len(cut):
                out[code[f]] += (np.searchsorted(cut, x[f]) * step[f]).astype("i2")         # missing values beyond the last
        return out

    def total(batches: Iterator[Tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        finds = []
        for own in trees:
            levels, values = as_levels(own, cuts, code, step) if binned else (None, None)
            finds.append((places(levels, cells), values) if binned else walk(own))
        for columns in batches:
            x = [c.to_numpy("f8") for c in (columns if isinstance(columns, tuple) else (columns,))]
            rows, out = packed(x) if binned else x, np.zeros(len(x[0]))
            for find, values in finds:
                out += values.take(find(rows).astype(np.intp))
            yield pd.Series(out)

    return F.pandas_udf(total, "double")(*[F.col(f"`{c}`").cast("double") for c in features])
