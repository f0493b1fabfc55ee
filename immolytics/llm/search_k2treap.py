"""Ranked lexical search with K2-treaps over the grid of terms and documents.

The documents are cut into shards of bounded size where they are read. A shard
is a grid: a row per term, a column per document in order of doc_id, a point
where a term occurs, its weight the impact (the part of the score that does not
depend on the item). The grid is stored as a K2-treap with k = 8: quadtree
cells, only those that hold points, each with the number of its children and the
greatest impact below it (in sixteenths of 2**-16, rounded up). Rows are spaced
as widely as a shard has columns, so a path settles its row first; from there on
a cell is one term and a range of 8**level documents, and its children are
contiguous. Cells above the points of a term that has at most ``FEW`` of them
are left out: the points stand for themselves on every level.

An item enters every shard with the rows of its terms. All row paths descend
together over the same document ranges: a range's bound is the sum of weight
times maximum over the rows, the best ranges are opened first, and ranges that
cannot reach the item's current last place are dropped. A task carries each
item's best documents from shard to shard; the tasks' answers are merged.

Items are taken in blocks of bounded size, so what is broadcast is bounded.

Defined cases: null and empty texts have no terms, are not counted and are never
found; a null doc_id ranks after all others of its score; repeated document rows
are documents of their own; the terms of repeated item_ids (nulls too) are
united; items without terms, or with unknown ones alone, give no rows; empty
tables give an empty result; other columns and their names do not matter.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import materialize
from .common import append_columns, decoded, slices
from .decontaminate_winnow import words_of as terms_of

TOP = 10
# Bytes of text and documents of a shard; a larger document is a shard of its own.
SHARD_BYTES, SHARD_DOCS = 4 << 20, 1 << 16
# Documents of a cell are cut into 8; terms of at most FEW documents have no cells above their points.
K_BITS, FEW = 3, 16
# Impacts are below 10**6: a maximum in steps of 16 takes two bytes.
STEP = 16
# Ranges opened first, and how many times more with every opening.
OPEN_FIRST, OPEN_MORE = 8, 4
# Bytes of text of the items searched at a time.
BLOCK_BYTES = 4 << 20
NO_ID = np.iinfo(np.int64).max

LEVEL = T.StructType([T.StructField("per_term", T.BinaryType()), T.StructField("range", T.BinaryType()),
                      T.StructField("most", T.BinaryType()), T.StructField("children", T.BinaryType())])
SHARD = T.StructType([T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("terms", T.BinaryType()),
                      T.StructField("df", T.BinaryType()), T.StructField("doc", T.BinaryType()),
                      T.StructField("impact", T.BinaryType()), T.StructField("levels", T.ArrayType(LEVEL))])


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """(N, L): documents with a term, and all their terms."""
    counted = append_columns(docs, [("n_terms", T.LongType())], lambda: lambda texts: [[len(terms_of(t)) for t in texts]], keep=())
    row = counted.agg(F.count_if(F.col("n_terms") > 0).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("l")).first()
    return int(row["n"]), int(row["l"])


def impacts(tf: np.ndarray, doc: np.ndarray, n_terms: np.ndarray, n_docs: int, n_all: int) -> np.ndarray:
    """(1000000000 * tf) div (1000 * tf + 8 * m) per point, with m = 100 - 90 + (90 * n * N) div L of its document."""
    norm = np.array([10 + (90 * n * n_docs) // n_all for n in n_terms.tolist()], np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * norm[doc])


def build_shard(doc_ids: list, texts: list[list[bytes]], n_docs: int, n_all: int) -> dict:
    """The K2-treap of some documents (term lists, none empty) as a row of the index."""
    order = sorted(range(len(doc_ids)), key=lambda i: NO_ID if doc_ids[i] is None else doc_ids[i])
    numbers: dict[bytes, int] = {}
    rows = [np.fromiter([numbers.setdefault(t, len(numbers)) for t in texts[i]], np.int64, len(texts[i])) for i in order]
    lengths = np.array([len(r) for r in rows], np.int64)
    keys = np.concatenate(rows) * SHARD_DOCS + np.repeat(np.arange(len(order)), lengths)
    keys, tf = np.unique(keys, return_counts=True)
    term, doc = keys // SHARD_DOCS, keys % SHARD_DOCS
    impact = impacts(tf, doc, lengths, n_docs, n_all)
    df = np.bincount(term, minlength=len(numbers))
    inner = df[term] > FEW
    term, at, most = term[inner], doc[inner], (impact[inner] + STEP - 1) // STEP
    levels = []
    while (len(order) - 1) >> (K_BITS * len(levels)) >= 1 << K_BITS:
        at = at >> K_BITS
        first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (term[1:] != term[:-1])))) if len(at) else np.zeros(0, np.int64)
        children = np.diff(np.concatenate((first, [len(at)])))
        most = np.maximum.reduceat(most, first) if len(first) else most
        term, at = term[first], at[first]
        levels.append({"per_term": np.bincount(term, minlength=len(numbers)).astype(np.int32).tobytes(),
                       "range": at.astype(np.uint16).tobytes(), "most": most.astype(np.uint16).tobytes(),
                       "children": children.astype(np.uint8).tobytes()})
    return {"doc_ids": [doc_ids[i] for i in order], "terms": b"\n".join(numbers), "df": df.astype(np.int32).tobytes(),
            "doc": doc.astype(np.uint16).tobytes(), "impact": impact.astype(np.uint32).tobytes(), "levels": levels}


def build_index(docs: DataFrame, size: tuple[int, int] | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard; ``size`` is ``corpus_size(docs)``."""
    n_docs, n_all = size or corpus_size(docs)
    schema = to_arrow_schema(SHARD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0

        def shard():
            return pa.RecordBatch.from_pylist([build_shard(ids, texts, n_docs, n_all)], schema=schema)

        for batch in batches:
            for part in slices(batch, 1):
                for doc_id, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    terms = terms_of(raw)
                    if not terms:
                        continue
                    if ids and (held + len(raw) > shard_bytes or len(ids) == SHARD_DOCS):
                        yield shard()
                        ids, texts, held = [], [], 0
                    ids.append(doc_id)
                    texts.append(terms)
                    held += len(raw)
        if ids:
            yield shard()

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, SHARD)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the runs that begin at ``starts``."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Shard:
    """A shard read from its row; level 0 holds the points."""

    def __init__(self, row: dict):
        self.doc_ids = np.array([NO_ID if i is None else i for i in row["doc_ids"]], np.int64)
        self.rows = {t: i for i, t in enumerate(row["terms"].split(b"\n"))}
        self.df = np.frombuffer(row["df"], np.int32)
        self.first, self.range = [_starts(self.df)], [np.frombuffer(row["doc"], np.uint16)]
        self.most = [np.frombuffer(row["impact"], np.uint32)]
        self.children, self.child = [None], [None]
        below = np.flatnonzero(np.repeat(self.df > FEW, self.df))         # the points that have cells above them
        for level in row["levels"]:
            self.first.append(_starts(np.frombuffer(level["per_term"], np.int32)))
            self.range.append(np.frombuffer(level["range"], np.uint16))
            self.most.append(np.frombuffer(level["most"], np.uint16))
            self.children.append(np.frombuffer(level["children"], np.uint8).astype(np.int64))
            self.child.append(below[_starts(self.children[-1])[:-1]])     # a cell's children follow each other
            below = np.arange(len(self.children[-1]))
        self.top = len(row["levels"])

    def cells(self, rows: np.ndarray, weights: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows' cells on a level, with the rows' weights."""
        first = self.first[level]
        sizes = first[rows + 1] - first[rows]
        return _spread(first[rows], sizes), np.repeat(weights, sizes)


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


class Best:
    """The best ``k`` (score, doc_id) of an item so far."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids))
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]

    def reaches(self, bounds: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Whether documents of at most these scores, of these or larger ids, may still enter."""
        if len(self.scores) < self.k:
            return bounds > 0
        return (bounds > self.scores[-1]) | ((bounds == self.scores[-1]) & (ids < self.ids[-1]))


def search_shard(shard: Shard, rows: np.ndarray, weights: np.ndarray, best: Best) -> int:
    """Enter a shard's documents into ``best``; returns the number of points that were scored.

    The queue holds states: ranges of one level that are still closed, by their
    best bound. A state is the cells of the rows in its ranges, and the points
    of the small terms there. Bounds are sums of 64-bit integers, so exact.
    """
    def sums(level, *parts):
        total = np.zeros((len(shard.doc_ids) - 1 >> (K_BITS * level)) + 1, np.int64)
        for at, gain in parts:
            np.add.at(total, at, gain)
        return total

    def score(points, gain):
        at = shard.range[0][points]
        total = sums(0, (at, gain))
        hit = np.flatnonzero(total)
        best.add(total[hit], shard.doc_ids[hit])
        return len(points)

    small = (shard.df[rows] <= FEW) | (shard.top == 0)
    points, point_weights = shard.cells(rows[small], weights[small], 0)
    gain = point_weights * shard.most[0][points]
    if not shard.top:
        return score(points, gain)
    scored, width, serial = 0, OPEN_FIRST, 0
    queue = [(0, shard.top, serial, (*shard.cells(rows[~small], weights[~small], shard.top), points, gain))]
    while queue:
        _, level, _, (cells, cell_weights, points, gain) = heapq.heappop(queue)
        cell_range, point_range = shard.range[level][cells], shard.range[0][points] >> (K_BITS * level)
        bounds = sums(level, (cell_range, cell_weights * shard.most[level][cells] * STEP), (point_range, gain))
        held = np.flatnonzero(bounds)
        held = held[best.reaches(bounds[held], shard.doc_ids[held << (K_BITS * level)])]
        if not len(held):
            continue
        held = held[np.lexsort((held, -bounds[held]))]
        state = np.zeros(len(bounds), np.int8)
        state[held[:width]], state[held[width:]] = 1, 2
        of_cell, of_point = state[cell_range], state[point_range]
        if len(held) > width:
            serial += 1
            later = (cells[of_cell == 2], cell_weights[of_cell == 2], points[of_point == 2], gain[of_point == 2])
            heapq.heappush(queue, (-int(bounds[held[width]]), level, serial, later))
        width *= OPEN_MORE
        cells, cell_weights, points, gain = cells[of_cell == 1], cell_weights[of_cell == 1], points[of_point == 1], gain[of_point == 1]
        sizes = shard.children[level][cells]
        below, below_weights = _spread(shard.child[level][cells], sizes), np.repeat(cell_weights, sizes)
        if level > 1:                                                   # children are no better than their range
            serial += 1
            heapq.heappush(queue, (-int(bounds[held[0]]), level - 1, serial, (below, below_weights, points, gain)))
        else:
            scored += score(np.concatenate((points, below)), np.concatenate((gain, below_weights * shard.most[0][below])))
    return scored


def blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """(item_id, set of terms) in blocks of about ``block_bytes`` of text; equal ids stand in one block."""
    rows = items.select("item_id", F.col("text").cast("binary").alias("text")).orderBy("item_id")
    block, held = [], 0
    for row in rows.toLocalIterator():
        raw = bytes(row["text"] or b"")
        if block and block[-1][0] == row["item_id"]:
            block[-1][1].update(terms_of(raw))
        else:
            if held > block_bytes:
                yield block
                block, held = [], 0
            block.append((row["item_id"], set(terms_of(raw))))
        held += len(raw)
    if block:
        yield block


def document_frequencies(index: DataFrame, terms: Iterable[bytes]) -> dict[bytes, int]:
    """Documents that hold each of the terms, over all shards."""
    wanted = index.sparkSession.sparkContext.broadcast(sorted(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted.value), np.int64)
        for batch in batches:
            for raw, df in zip(batch.column(0), batch.column(1)):
                rows, counts = {t: i for i, t in enumerate(raw.as_py().split(b"\n"))}, np.frombuffer(df.as_py(), np.int32)
                total += np.array([counts[rows[t]] if t in rows else 0 for t in wanted.value], np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["term", "df"])

    counted = index.select("terms", "df").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    return {wanted.value[t]: n for t, n in zip(counted["term"].to_pylist(), counted["df"].to_pylist())}


def _found(index: DataFrame, block: list[tuple], n_docs: int, k: int) -> DataFrame:
    """(item, doc_id, score): every task's best ``k`` documents of each item of a block (``item`` is its place there)."""
    spark = index.sparkSession
    df = document_frequencies(index, set().union(*[terms for _, terms in block]))
    weight = {t: int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * n + 1)))) for t, n in df.items()}
    queries = spark.sparkContext.broadcast([{t: weight[t] for t in terms if t in weight} for _, terms in block])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries.value]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.slice(i, 1).to_pylist()[0])
                for terms, b in zip(queries.value, best):
                    held = [(shard.rows[t], w) for t, w in terms.items() if t in shard.rows]
                    if held:
                        search_shard(shard, *[np.array(c, np.int64) for c in zip(*held)], b)
        for item, b in enumerate(best):
            if len(b.ids):
                ids = pa.array([None if x == NO_ID else x for x in b.ids.tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b.ids), item, np.int32)), ids, pa.array(b.scores)],
                                                 names=["item", "doc_id", "score"])

    return index.mapInArrow(run, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, index: DataFrame | None = None, size: tuple[int, int] | None = None,
           shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per item its ``k`` best documents of score above 0: item_id, rank (from 1), doc_id, score.

    ``index`` (``build_index``, stored) and ``size`` (``corpus_size``) are made of ``docs`` where they are not given.
    """
    spark = docs.sparkSession
    size = size or corpus_size(docs)
    if index is None:
        index = materialize(build_index(docs, size, shard_bytes), "search-index")
    item_type = items.schema["item_id"].dataType
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    out = spark.createDataFrame([], T.StructType([T.StructField("item_id", item_type), T.StructField("rank", T.IntegerType()),
                                                  T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    for block in blocks(items, block_bytes):
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], T.StructType(
            [T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type)]))
        first = _found(index, block, size[0], k).withColumn("rank", rank).where(F.col("rank") <= k)
        out = out.unionByName(first.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))   # a block's items
    return out
