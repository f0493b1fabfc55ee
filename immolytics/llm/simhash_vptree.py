"""SimHash near-duplicates, searched with a vantage-point tree over Hamming distance.

1. Every document gets a 64-bit fingerprint of its word shingles. Equal
   fingerprints are one point, represented by the smallest doc_id.
2. A vantage-point tree is fitted on a bounded sample of the points. It has
   enough leaves for ``LEAF`` points each; every inner node holds a vantage
   point and a radius that splits Hamming space in two.
3. Every point goes to its home leaf and, by the triangle bound, to every leaf
   on the other side of a radius within ``max_bits`` of it. So both points of a
   linked pair meet in the home leaf of one of them. A leaf's home points are cut
   into blocks and its visitors into parts, compared group by group.
4. A group compares its points exactly and returns a spanning forest of its
   links, at most one row per point.
5. Components come from alternating large-star and small-star rounds on these
   edges, each round written to the shared folder.

Defined cases: null and empty texts (no words) have fingerprint zero and link
like any other; texts of fewer words than a shingle are one shingle; repeated
rows share their component; a null doc_id is a member of its component but
never names it unless all its members are null; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import materialize
from .common import append_columns

SHINGLE = 3
MAX_BITS = 3
SEED = 42
# Points planned per leaf; points sampled per leaf to fit the tree, and at most in all (8 MB).
LEAF = 16_384
PER_LEAF = 128
# Tasks that compare the home points of a leaf of the planned size.
BLOCKS = 4
# Points that a block meets in one group, about.
VISITORS = 1 << 18
MOST_SAMPLE = 1_000_000
# Fewest sample points on which a radius is still chosen.
LEAST_SAMPLE = 16

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(raw: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a UTF-8 text: a bit is 1 if set in over half the shingles' XXH64 (repeats included)."""
    words = (raw or b"").translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, stops)]), np.uint8)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 8192):                          # bits of some thousand hashes at a time
        ones += np.unpackbits(hashes[8 * at:8 * (at + 8192)].reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns and ``point`` per row; ``point`` holds the fingerprint's 64 bits as a signed long."""
    def make():
        def compute(texts):
            return [np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)]
        return compute
    return append_columns(docs, [("point", T.LongType())], make, keep=keep)


class VantageTree:
    """Binary vantage-point tree over 64-bit points: arrays of vantage points, radii and children."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.vantage, self.radius, self.inside, self.outside = [], [], [], []
        self.n_leaves = 0
        self.root = self._grow(sample, leaves, np.random.default_rng(SEED))

    def _grow(self, sample, leaves, rng) -> int:
        """Index of the subtree's node; leaf number ``i`` is written as ``-1 - i``."""
        if leaves > 1 and len(sample) >= LEAST_SAMPLE:
            best = None
            for v in rng.choice(sample, min(12, len(sample)), replace=False):
                distance = np.bitwise_count(sample ^ v)
                radius = int(np.median(distance))
                within = distance <= radius
                share = within.mean()
                near = (np.abs(distance.astype(int) - radius - 0.5) <= MAX_BITS).mean()
                cost = near + 2 * max(share, 1 - share)   # few points near the boundary, even halves
                if 0 < share < 1 and (best is None or cost < best[0]):
                    best = (cost, v, radius, within)
            if best is not None:
                _, v, radius, within = best
                node = len(self.vantage)
                for column, value in ((self.vantage, v), (self.radius, radius), (self.inside, 0), (self.outside, 0)):
                    column.append(value)
                first = min(leaves - 1, max(1, round(leaves * within.mean())))
                self.inside[node] = self._grow(sample[within], first, rng)
                self.outside[node] = self._grow(sample[~within], leaves - first, rng)
                return node
        self.n_leaves += 1
        return -self.n_leaves

    def route(self, points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index, leaf, home) of every leaf a point must visit to meet all points within ``reach``.

        A linked pair parted at a node straddles its radius. The point inside
        visits the other side; the point outside stays. Visitors go wherever a
        home point within reach can be.
        """
        found = []
        todo = [(self.root, np.arange(len(points)), np.ones(len(points), bool))]
        while todo:
            node, index, home = todo.pop()
            if not len(index):
                continue
            if node < 0:
                found.append((index, np.full(len(index), -1 - node, np.int32), home))
                continue
            distance = np.bitwise_count(points[index] ^ self.vantage[node]).astype(np.int16)
            radius = self.radius[node]
            within = distance <= radius
            into = np.where(home, within, distance - reach <= radius)
            out = np.where(home, ~within, distance + reach > radius)
            guest = home & within & (distance + reach > radius)
            todo.append((self.inside[node], index[into], home[into]))
            todo.append((self.outside[node], np.concatenate([index[out], index[guest]]),
                         np.concatenate([home[out], np.zeros(guest.sum(), bool)])))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, bool)
        return tuple(np.concatenate(x) for x in zip(*found))


def fit_tree(points: DataFrame, n_points: int, leaf: int = LEAF) -> VantageTree:
    """Tree of about ``n_points / leaf`` leaves, fitted on about ``PER_LEAF`` hashed points for each.

    At most ``MOST_SAMPLE`` points reach the driver; from then on leaves grow
    and are compared in blocks.
    """
    share = min(1.0, PER_LEAF / leaf, MOST_SAMPLE / max(1, n_points))
    chosen = F.pmod(F.xxhash64("point", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30))
    rows = points.select("point").where(chosen).toArrow()
    sample = np.sort(np.asarray(rows["point"])).view(np.uint64)
    return VantageTree(sample, max(1, math.ceil(n_points / leaf)))


def _forest(points: np.ndarray, home: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the pairs within ``reach`` that have a home point: (node, root) indices.

    Some home points at a time are compared with all points; whoever is close
    is united with them, so dense groups cost no list of their pairs.
    """
    n = len(points)
    parent, homes = np.arange(n), np.flatnonzero(home)
    step = max(1, (1 << 20) // max(1, n))
    for at in range(0, len(homes), step):
        close = np.bitwise_count(points[homes[at:at + step], None] ^ points[None, :]) <= reach
        for i in np.flatnonzero(close.sum(axis=1) > 1):   # each is close to itself
            near = np.flatnonzero(close[i])
            top = parent[near]
            while (parent[top] != top).any():
                top = parent[top]
            least = top.min()
            parent[top] = least
            parent[near] = least
    while (parent[parent] != parent).any():
        parent = parent[parent]
    linked = np.flatnonzero(parent != np.arange(n))
    return linked, parent[linked]


def links(points: DataFrame, max_bits: int = MAX_BITS, leaf: int = LEAF, visitors: int = VISITORS) -> DataFrame:
    """Edges (a, b) between distinct ``point`` values that connect all pairs within ``max_bits`` bits."""
    spark = points.sparkSession
    n_points = points.count()
    tree = spark.sparkContext.broadcast(fit_tree(points, n_points, leaf))
    schema = "leaf int, point long, home boolean"

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(batch.column(0)).view(np.uint64)
            for at in range(0, len(values), 8192):
                part = values[at:at + 8192]
                index, leaves, home = tree.value.route(part, max_bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaves, pa.int32()), pa.array(part[index].view(np.int64)), pa.array(home)],
                    names=["leaf", "point", "home"])

    visits = materialize(points.select("point").mapInArrow(route, schema), "simhash-visits")
    # Home points are cut into blocks and all who visit the leaf into parts; each block meets each part in a group of
    # its own, so a group is bounded however large the leaf: a block's homes and the part's others.
    sizes = visits.groupBy("leaf").agg(F.count_if("home").alias("homes"), F.count("*").alias("all"))
    cuts = sizes.where("homes > 0").select("leaf", F.ceil(F.col("homes") * BLOCKS / leaf).cast("int").alias("blocks"),
                                           F.ceil(F.col("all") / visitors).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int")
    part = F.pmod(F.xxhash64("point", F.lit(2)), F.col("parts")).cast("int")

    def places(n: Column, at) -> Column:
        return F.transform(F.sequence(F.lit(0), n - 1), at)

    as_home = places(F.col("parts"), lambda p: F.struct(F.col("own").alias("block"), p.alias("part"), F.lit(True).alias("home")))
    as_other = places(F.col("blocks"), lambda b: F.struct(b.alias("block"), F.col("mine").alias("part"), F.lit(False).alias("home")))
    placed = F.when(F.col("home"), F.concat(as_home, F.filter(as_other, lambda x: x["block"] != F.col("own")))).otherwise(as_other)
    spread = (visits.join(F.broadcast(cuts), "leaf")        # a row per leaf: MOST_SAMPLE / LEAST_SAMPLE at most
              .withColumn("own", own).withColumn("mine", part)
              .select("leaf", "point", F.inline(placed))
              .repartition(1 + n_points * BLOCKS // leaf, "leaf", "block", "part"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        values = pdf["point"].to_numpy()
        a, b = _forest(values.view(np.uint64), pdf["home"].to_numpy(), max_bits)
        return pd.DataFrame({"a": values[a], "b": values[b]})

    return spread.groupBy("leaf", "block", "part").applyInPandas(compare, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of ``edges`` (a, b) with the smallest node of its component.

    Alternates large-star (each larger neighbour is linked to the least of the
    neighbourhood) and small-star (the same for smaller neighbours) until the
    edge set no longer changes. Neighbourhoods are never gathered: each star is
    an aggregated minimum joined back to the edges.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            sides = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            sides = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        near = sides.join(least, "a")
        if large:
            return near.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        own = least.select("a", F.col("m").alias("b"))
        return near.select(F.col("b").alias("a"), F.col("m").alias("b")).union(own).where("a <> b").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                          .distinct(), "components")
    seen = state(current)
    while True:
        current = materialize(star(star(current, True), False), "components")
        now = state(current)
        if now == seen:
            return current.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
        seen = now


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, leaf: int = LEAF,
                    keep=()) -> DataFrame:
    """Per document row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable) and group.

    ``group`` names the component even if none of its rows has a doc_id. Columns of
    ``keep`` are passed through.
    """
    keep = ["doc_id"] + [c for c in keep if c not in ("doc_id", "fingerprint", "component_id", "group", "point")]
    marked = materialize(fingerprints(docs, shingle, keep), "simhash-points")
    points = materialize(marked.groupBy("point").agg(F.min("doc_id").alias("doc")), "simhash-distinct")
    joined = materialize(components(links(points, max_bits, leaf)), "simhash-components")
    named = points.join(joined, points["point"] == joined["node"], "left").select(
        "point", "doc", F.coalesce("root", "point").alias("group"))
    smallest = named.groupBy("group").agg(F.min("doc").alias("component_id"))
    of_point = named.select("point", "group").join(smallest, "group")
    return marked.join(of_point, "point").select(
        *keep, F.lower(F.lpad(F.hex("point"), 16, "0")).alias("fingerprint"), "component_id", "group")
