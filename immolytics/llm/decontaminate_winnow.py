"""Benchmark decontamination by winnowing.

Words are hashed, k consecutive words form a k-gram, and of every ``w``
consecutive k-grams those of least hash are kept as fingerprints. Any shared
run of at least k + w - 1 words therefore keeps the same fingerprint on both
sides; with k + w - 1 = ``window`` no shared window is missed. A document
fingerprint that the benchmark may hold is extended to the whole windows around
it, at most w of them, and these meet the benchmark's distinct windows in a
join on hash and words. So a phrase that many texts share costs a row per
window that really occurs, not one per pair of places.

Items of fewer than ``window`` words are one window of their own length n:
they are winnowed with k = n and w = 1.

Two bit maps (the benchmark's fingerprints and its windows, hashed) travel to
the tasks so that documents emit only windows that the benchmark may hold.
Their size follows the benchmark's, up to ``2**MOST_BITS`` bits. They only thin
the shuffle: results do not depend on them.

Defined cases: null and empty texts have no words and are not contaminated;
items without words match nothing; repeated document rows keep one result row
each; repeated benchmark rows count once per item_id; windows of a null item_id
are hits like others, but a null is no item and is not listed; empty tables give
empty or uncontaminated results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import materialize
from .common import Memo, append_columns, quoted

WINDOW = 10
K = 6
LEAST_BITS, MOST_BITS = 20, 28
# Ways in which the rows of one window are split before the join.
SALTS = 8

# Lower-case A-Z; every other ASCII byte but digits and a-z separates words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
              for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xBF58476D1CE4E5B9)

HIT = T.StructType([T.StructField("hash", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("pos", T.IntegerType()),
                    T.StructField("words", T.StringType())])


def words_of(raw: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: runs of digits, letters a-z (A-Z folded) and non-ASCII characters."""
    return (raw or b"").translate(_FOLD).split()


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def gram_hashes(words: np.ndarray, k: int, family: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words; ``family`` keeps window lengths apart."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, family, np.uint64)
    for j in range(k):
        total = total * _STEP + words[j:j + n]
    return _scrambled(total)


def winnowed(hashes: np.ndarray, w: int) -> np.ndarray:
    """Positions that hold the least hash of some run of ``w`` hashes (ties: all of them)."""
    if w <= 1 or len(hashes) < w:
        return np.arange(len(hashes)) if w <= 1 else np.zeros(0, np.int64)
    n = len(hashes) - w + 1
    least = hashes[:n].copy()
    for j in range(1, w):
        np.minimum(least, hashes[j:j + n], out=least)
    kept = np.zeros(len(hashes), bool)
    for j in range(w):
        kept[j:j + n] |= hashes[j:j + n] == least
    return np.flatnonzero(kept)


def _in(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit map holds the hashes' slots."""
    slot = hashes >> np.uint64(64 - (8 * len(table) - 1).bit_length())
    return (table[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def fingerprints(hashed: np.ndarray, n: int, window: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(places, hashes, size) of the fingerprints of windows of ``n`` words: winnowed k-grams, or all runs of a short length."""
    size, w = (k, window - k + 1) if n == window else (n, 1)
    hashes = gram_hashes(hashed, size, n)
    at = winnowed(hashes, w)
    return at, hashes[at], size


def windows_around(at: np.ndarray, size: int, n: int, n_words: int) -> np.ndarray:
    """Starts of the windows of ``n`` words that hold a run of ``size`` words at one of the places ``at``."""
    starts = (at[:, None] - np.arange(n - size, -1, -1)[None, :]).ravel()
    return np.unique(starts[(starts >= 0) & (starts + n <= n_words)])


# Windows are hashed apart from fingerprints.
_WINDOWS = 1 << 20


def _hits(words: list[bytes], hashed: np.ndarray, n: int, window: int, k: int, maps=None) -> Iterator[dict]:
    """The windows of ``n`` words around fingerprints; with bit maps only those that both may hold."""
    at, hashes, size = fingerprints(hashed, n, window, k)
    if maps is not None and len(at):
        at = at[_in(maps[0], hashes)]
    if not len(at):
        return
    starts = windows_around(at, size, n, len(words))
    hashes = gram_hashes(hashed, n, _WINDOWS + n)[starts]
    if maps is not None:
        kept = _in(maps[1], hashes)
        starts, hashes = starts[kept], hashes[kept]
    for start, h in zip(starts.tolist(), hashes.view(np.int64).tolist()):
        yield {"hash": h, "n": n, "pos": start, "words": b" ".join(words[start:start + n]).decode("utf-8", "replace")}


def _maker(window: int, k: int, lengths: list[int] | None, bits=None):
    """Task function: number of words, windows and (without ``lengths``) fingerprints per text.

    ``lengths`` are the window lengths to look up in documents. None is the
    benchmark side: a text of fewer than ``window`` words is one window.
    """
    def make():
        ids = Memo(lambda word: xxhash.xxh64_intdigest(word))
        maps = None if bits is None else bits.value

        def compute(texts):
            counts, found, prints = [], [], []
            for raw in texts:
                words = words_of(raw)
                counts.append(len(words))
                hashed = np.fromiter(map(ids.__getitem__, words), np.uint64, len(words))
                own = lengths if lengths is not None else [min(window, len(words))] * bool(words)
                found.append([row for n in own if len(words) >= n for row in _hits(words, hashed, n, window, k, maps)])
                if lengths is None:
                    prints.append([h for n in own for h in fingerprints(hashed, n, window, k)[1].view(np.int64).tolist()])
            return [counts, found] + ([prints] if lengths is None else [])
        return compute
    return make


def benchmark_windows(benchmark: DataFrame, window: int, k: int) -> DataFrame:
    """(item_id, windows, fingerprints) per benchmark row."""
    fields = [("n_words", T.LongType()), ("windows", T.ArrayType(HIT)), ("fingerprints", T.ArrayType(T.LongType()))]
    return append_columns(benchmark, fields, _maker(window, k, None), keep=("item_id",))


def _bit_map(hashes: DataFrame) -> np.ndarray:
    """Bit map of column ``hash``, 64 bits for each up to ``2**MOST_BITS``: at most ``2**MOST_BITS / 64`` rows reach the driver."""
    bits = min(MOST_BITS, max(LEAST_BITS, (64 * hashes.count()).bit_length()))
    slot = F.shiftrightunsigned("hash", 64 - bits)
    words = (hashes.groupBy(F.shiftright(slot, 6).cast("int").alias("word"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - bits}) & 63 as int))")).alias("mask"))
             .toArrow())
    out = np.zeros(2 ** bits // 64, np.int64)
    out[np.asarray(words["word"])] = np.asarray(words["mask"])
    return out.view(np.uint8)


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         k: int = K) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, spans, windows): word counts, hit windows, and the items of the benchmark's windows.

    ``documents``: doc_id, text_key (hash of the text) and n_words per input
    row. ``spans``: doc_id, text_key, first and last (word positions, last
    exclusive), hash, n and words of every window that occurs. ``windows``: the
    same three and item_id.
    """
    spark = docs.sparkSession
    side = materialize(benchmark_windows(benchmark, window, k), "winnow-benchmark")
    of_item = side.select("item_id", F.explode("windows").alias("g")).select("item_id", "g.hash", "g.n", "g.words").distinct()
    distinct = materialize(of_item.select("hash", "n", "words").distinct(), "winnow-windows")
    lengths = [r.n for r in distinct.select("n").distinct().collect()]              # ``window`` values at most
    prints = side.select(F.explode("fingerprints").alias("hash"))
    maps = spark.sparkContext.broadcast((_bit_map(prints), _bit_map(distinct)))
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    rows = materialize(append_columns(
        keyed, [("n_words", T.LongType()), ("windows", T.ArrayType(HIT))],
        _maker(window, k, sorted(lengths), maps), keep=("doc_id", "text_key")), "winnow-documents")

    found = (rows.where(F.size("windows") > 0).select("doc_id", "text_key", F.inline("windows"))
             .withColumn("salt", F.pmod(F.xxhash64("doc_id", "pos"), F.lit(SALTS)).cast("int")))
    salted = distinct.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spans = found.join(salted, ["hash", "n", "words", "salt"]).select(
        "doc_id", "text_key", F.col("pos").alias("first"), (F.col("pos") + F.col("n")).alias("last"), "hash", "n", "words")
    return rows.select("doc_id", "text_key", "n_words"), materialize(spans, "winnow-hits"), of_item


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """Per document row: doc_id, text_key, n_words, n_hit, n_items, items_sha256 and contaminated.

    A document word inside any occurrence of a benchmark window is hit; items
    count if one of their windows occurs.
    """
    rows, spans, windows = hits(docs, benchmark, window, k)
    key, name = ["doc_id", "text_key"], ["hash", "n", "words"]
    w = Window.partitionBy(*key).orderBy("first", "last")
    earlier = F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    n_hit = (spans.groupBy(*key, "first").agg(F.max("last").alias("last"))
             .withColumn("from", F.greatest("first", F.coalesce(earlier, F.lit(0))))
             .groupBy(*key).agg(F.sum(F.greatest(F.col("last") - F.col("from"), F.lit(0))).alias("n_hit")))
    of_window = windows.select(*name, F.col("item_id").cast("string").alias("item"))
    items = (spans.select(*key, *name).distinct().join(of_window, name).select(*key, "item").distinct()
             .groupBy(*key).agg(F.array_sort(F.collect_list("item")).alias("items")))
    found = n_hit.alias("a").join(items.alias("b"), (F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")))
                                  & (F.col("a.text_key") == F.col("b.text_key")))
    found = found.select(F.col("a.doc_id").alias("__doc"), F.col("a.text_key").alias("__key"), "n_hit", "items")
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_key") == F.col("__key")), "left")
    return joined.select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))
