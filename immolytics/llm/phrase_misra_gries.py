"""Phrase collocation mining with mergeable Misra-Gries summaries.

1. Every task counts its word n-grams and sends them, hashed, to the hash
   partitions as summaries. A partition merges them into one Misra-Gries
   summary of ``mass / threshold + 1`` counters, where mass is the number of
   n-grams that fell into the partition: what the counters lose together is less
   than the threshold, so no n-gram that occurs ``threshold`` times is lost.
2. A second pass counts exactly, by their words, the n-grams that survive.
   A bit map of bounded size (the survivors, hashed) thins what the tasks send;
   whatever it lets through besides them is counted too and fails the threshold.
3. Counts of a phrase and of its parts meet in one join and give the scores.

N-grams are unigrams to ``longest`` words, within pieces and per language. The
number of partitions follows from the bytes of text, so a partition's summary
keeps its size however large the corpus.

Defined cases: null and empty texts have no words; a null lang is ``und``;
repeated rows count as often as they stand; equal scores rank by count, then by
phrase in UTF-8 byte order; an empty table gives an empty result; other columns
and their names do not matter. Long texts are cut into runs of words whose
n-grams are counted at the run they begin in.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import decoded, slices

THRESHOLD = 10
SHORTEST, LONGEST = 2, 3
TOP = 2000
UNKNOWN = "und"
COVERED_PERCENT = 50
# Bytes of text planned per hash partition (some 400,000 words, 1.2 million n-grams).
PARTITION_BYTES = 1 << 21
LEAST_PARTITIONS, MOST_BITS = 32, 26
# Words of a run, bits of a word's number in a key, and entries that a task keeps before it sends them.
RUN_WORDS, ID_BITS = 1 << 19, 21
TASK_ENTRIES = 1_500_000
# Parts into which a language's candidates are dealt before its first ones are taken.
SALTS = 64

_FOLD = bytes.maketrans(string.ascii_uppercase.encode() + b".,;:!?\n\x0b\x0c\r",
                        string.ascii_lowercase.encode() + b"\n" * 10)
_BREAK = b"."                                    # a full stop ends a piece, so no word is one
_STEP = np.uint64(0xBF58476D1CE4E5B9)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ID = np.uint64((1 << ID_BITS) - 1)


def words_of(raw: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text, with a ``.`` between pieces."""
    return (raw or b"").translate(_FOLD).replace(b"\n", b" . ").split()


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def merged(hashes: np.ndarray, counters: np.ndarray, lost: int, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Misra-Gries merge: counters of equal hashes added up, then all lowered until ``capacity`` are left.

    ``lost`` is what a counter may lack; it never exceeds mass / (capacity + 1).
    """
    hashes, counters = _summed(hashes, counters)
    if len(hashes) > capacity:
        cut = np.partition(counters, len(counters) - capacity - 1)[len(counters) - capacity - 1]
        kept = counters > cut
        hashes, counters, lost = hashes[kept], counters[kept] - cut, lost + int(cut)
    return hashes, counters, lost


class _Counts:
    """Counts of keys in sorted arrays, united whenever the unsorted rest has grown as large."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting, self.n_waiting = [], 0

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            self.waiting.append(_summed(keys, np.ones(len(keys), np.int64)))
            self.n_waiting += len(self.waiting[-1][0])
            if self.n_waiting > max(500_000, len(self.keys)):
                self.unite()

    def unite(self) -> None:
        if self.waiting:
            parts = [(self.keys, self.counts), *self.waiting]
            self.keys, self.counts = _summed(*[np.concatenate(c) for c in zip(*parts)])
            self.waiting, self.n_waiting = [], 0


class _Task:
    """One task's words, numbered, and its n-gram counts per language.

    A key holds the numbers of an n-gram's words, 21 bits each, so equal keys are
    equal words. Numbers and counts begin anew once there are too many of either.
    """

    def __init__(self, longest: int, wanted: Callable[[np.ndarray], np.ndarray] | None = None):
        self.longest, self.wanted = longest, wanted
        self.reset()

    def reset(self) -> None:
        self.ids, self.words, self.hashes = {_BREAK: 0}, [b""], [0]
        self.of_lang: dict[str, _Counts] = {}
        self.n_words: dict[str, int] = {}

    def number(self, words: list[bytes]) -> np.ndarray:
        ids = self.ids
        for w in set(words).difference(ids):
            ids[w] = len(self.words)
            self.words.append(w)
            self.hashes.append(xxhash.xxh64_intdigest(w))
        return np.fromiter(map(ids.__getitem__, words), np.uint64, len(words))

    def full(self) -> bool:
        return len(self.words) > 1 << (ID_BITS - 1) or TASK_ENTRIES < sum(len(c.keys) + c.n_waiting for c in self.of_lang.values())

    def add(self, lang: str, words: list[bytes], own: int) -> None:
        """Count the n-grams that begin at one of the first ``own`` words."""
        ids = self.number(words)
        table = np.array(self.hashes, np.uint64)[ids.astype(np.int64)] if self.wanted else None
        counts = self.of_lang.setdefault(lang, _Counts())
        self.n_words[lang] = self.n_words.get(lang, 0) + int(np.count_nonzero(ids[:own]))
        whole, keys, hashes = ids != 0, ids, None
        for size in range(1, self.longest + 1):
            n = min(own, len(ids) - size + 1)
            if n <= 0:
                return
            last = ids[size - 1:size - 1 + n]
            whole = whole[:n] & (last != 0)
            if size > 1:
                keys = (keys[:n] << np.uint64(ID_BITS)) | last
            if table is None:
                counts.add(keys[:n][whole])
                continue
            begun = np.full(n, _seed(lang), np.uint64) if size == 1 else hashes[:n]
            hashes = begun * _STEP + table[size - 1:size - 1 + n]
            counts.add(keys[:n][whole][self.wanted(_scrambled(hashes[whole]))])

    def grams(self) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """(lang, keys, counts) of all that was counted."""
        for lang, counts in self.of_lang.items():
            counts.unite()
            yield lang, counts.keys, counts.counts

    def sized(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """For each size, the places of its keys and the word numbers at each position."""
        for size in range(1, self.longest + 1):
            lo, hi = 1 << (ID_BITS * (size - 1)), min(1 << (ID_BITS * size), (1 << 64) - 1)
            at = np.flatnonzero((keys >= np.uint64(lo)) & (keys < np.uint64(hi)))
            yield at, [((keys[at] >> np.uint64(ID_BITS * (size - 1 - j))) & _ID).astype(np.int64) for j in range(size)]

    def gram_hashes(self, lang: str, keys: np.ndarray) -> np.ndarray:
        out, table = np.zeros(len(keys), np.uint64), np.array(self.hashes, np.uint64)
        for at, parts in self.sized(keys):
            total = np.full(len(at), _seed(lang), np.uint64)
            for p in parts:
                total = total * _STEP + table[p]
            out[at] = _scrambled(total)
        return out

    def phrases(self, keys: np.ndarray) -> tuple[list[int], list[str]]:
        """Size and space-joined words of every key."""
        sizes, texts = [0] * len(keys), [""] * len(keys)
        for at, parts in self.sized(keys):
            for i, row in zip(at.tolist(), zip(*[p.tolist() for p in parts])):
                sizes[i], texts[i] = len(row), decoded(b" ".join([self.words[w] for w in row]))
        return sizes, texts


def _seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang))


def _counted(docs: DataFrame, longest: int, send: Callable, schema: str, wanted=None) -> DataFrame:
    """Rows that ``send`` makes of every task's counts; ``wanted`` makes the filter of n-gram hashes."""
    frame = docs.select(F.col("text").cast("binary").alias("text"),
                        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = _Task(longest, wanted() if wanted else None)

        def runs(lang, words):
            for at in range(0, len(words), RUN_WORDS):
                task.add(lang, words[at:at + RUN_WORDS + longest - 1], min(RUN_WORDS, len(words) - at))
                if task.full():
                    yield from send(task)
                    task.reset()

        for batch in batches:
            for part in slices(batch, 0):
                by_lang: dict[str, list[bytes]] = {}
                for raw, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = words_of(raw)
                    if words:
                        by_lang.setdefault(lang, []).extend(words)
                        by_lang[lang].append(_BREAK)
                for lang, words in by_lang.items():
                    yield from runs(lang, words)
        yield from send(task)

    return frame.mapInArrow(run, schema)


def _planes(values: np.ndarray, size: int) -> bytes:
    """Little-endian bytes, all first bytes before all second ones: the high bytes of sorted hashes compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, size).T).tobytes()


def _from_planes(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).reshape(-1).view(dtype)


def survivors(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST,
              partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """Hashes (``hash``) of all n-grams that may occur ``threshold`` times, from one summary per hash partition."""
    n_bytes = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = int(max(LEAST_PARTITIONS, n_bytes / partition_bytes) - 1).bit_length()

    def send(task: _Task):
        found = [(task.gram_hashes(lang, keys), counts) for lang, keys, counts in task.grams() if len(keys)]
        if not found:
            return
        hashes, counts = _summed(*[np.concatenate(c) for c in zip(*found)])
        part = (hashes >> np.uint64(64 - bits)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(part)]):
            yield pa.RecordBatch.from_arrays(
                [pa.array([part[a]], pa.int64()), pa.array([int(counts[a:b].sum())], pa.int64()),
                 pa.array([_planes(hashes[a:b], 8)], pa.binary()), pa.array([_planes(counts[a:b], 8)], pa.binary())],
                names=["part", "mass", "hashes", "counters"])

    def merge(table: pa.Table) -> pa.Table:
        capacity = sum(table.column("mass").to_pylist()) // threshold + 1
        hashes, counters, lost = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        waiting, n_waiting = [], 0
        for batch in table.to_batches():
            for h, c in zip(batch.column("hashes"), batch.column("counters")):
                waiting.append((_from_planes(h.as_py(), np.uint64), _from_planes(c.as_py(), np.int64)))
                n_waiting += len(waiting[-1][0])
                if n_waiting > max(200_000, len(hashes)):
                    hashes, counters, lost = merged(*[np.concatenate(x) for x in zip((hashes, counters), *waiting)], lost, capacity)
                    waiting, n_waiting = [], 0
        hashes, counters, lost = merged(*[np.concatenate(x) for x in zip((hashes, counters), *waiting)], lost, capacity)
        return pa.table({"hash": hashes[counters + lost >= threshold].view(np.int64)})

    sent = _counted(docs, longest, send, "part long, mass long, hashes binary, counters binary")
    return sent.groupBy("part").applyInArrow(merge, "hash long")


def bit_map(hashes: DataFrame, bits: int) -> np.ndarray:
    """``2**bits`` bits, set where a hash begins so: at most ``2**bits / 64`` rows reach the driver."""
    slot = F.shiftrightunsigned("hash", 64 - bits)
    words = (hashes.groupBy(F.shiftright(slot, 6).cast("int").alias("word"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - bits}) & 63 as int))")).alias("mask"))
             .toArrow())
    out = np.zeros(2 ** bits // 64, np.int64)
    out[np.asarray(words["word"])] = np.asarray(words["mask"])
    return out.view(np.uint8)


def gram_counts(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST,
                partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(lang, size, phrase, f): exact counts of all n-grams that occur ``threshold`` times; size 0 counts all words."""
    hashes = materialize(survivors(docs, threshold, longest, partition_bytes), "phrase-survivors")
    bits = min(MOST_BITS, max(20, (16 * hashes.count()).bit_length()))
    known = docs.sparkSession.sparkContext.broadcast(bit_map(hashes, bits))

    def wanted():
        table, shift = known.value, np.uint64(64 - bits)

        def test(h: np.ndarray) -> np.ndarray:
            slot = h >> shift
            return (table[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return test

    def send(task: _Task):
        for lang, keys, counts in task.grams():
            sizes, texts = task.phrases(keys)
            for at in range(0, len(keys), 50_000):
                some = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(texts[some]), pa.string()), pa.array(sizes[some], pa.int32()),
                     pa.array(texts[some], pa.string()), pa.array(counts[some], pa.int64())], names=["lang", "size", "phrase", "f"])
        for lang, n in task.n_words.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([0], pa.int32()), pa.array([""]), pa.array([n], pa.int64())],
                names=["lang", "size", "phrase", "f"])

    sent = _counted(docs, longest, send, "lang string, size int, phrase string, f long", wanted)
    total = sent.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return total.where((F.col("size") == 0) | (F.col("f") >= threshold))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (l * r)) in 38-digit decimals: exact for counts below 10**15."""
    wide = [c.cast("decimal(16,0)") for c in (a, left, right)]
    square = (F.lit(1000000).cast("decimal(7,0)") * (wide[0] * wide[0]).cast("decimal(31,0)")).cast("decimal(38,0)")
    under = (wide[1] * wide[2]).cast("decimal(38,0)")
    return F.call_function("div", square, under).cast("long")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, shortest: int = SHORTEST, longest: int = LONGEST,
                 top: int = TOP, covered_percent: int = COVERED_PERCENT, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """Per lang the first ``top`` phrases: lang, rank, phrase, a, l, r, n, score, cut (words before the scored cut).

    Phrases have ``shortest`` to ``longest`` (at most 3) words and occur
    ``threshold`` times; one inside a longer candidate with at least
    ``covered_percent`` of its occurrences is dropped.
    """
    if not 2 <= shortest <= longest <= 3:
        raise ValueError("phrases have two or three words")
    counts = materialize(gram_counts(docs, threshold, longest, partition_bytes), "phrase-counts")
    words = F.split("phrase", " ")
    # Parts of a candidate that begin or end it, and inner ones that may be candidates themselves.
    spans = F.filter(
        F.flatten(F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda i: F.transform(
            F.sequence(F.lit(1), F.col("size") - i), lambda m: F.struct(i.alias("start"), m.alias("len"))))),
        lambda s: (s["len"] < F.col("size")) & ((s["start"] == 0) | (s["start"] + s["len"] == F.col("size")) | (s["len"] >= shortest)))
    parts = (counts.where(F.col("size") >= shortest)
             .select("lang", "phrase", "size", F.col("f").alias("a"), F.inline(spans))
             .withColumn("part", F.array_join(F.slice(words, F.col("start") + 1, F.col("len")), " ")))
    met = parts.join(counts.where("size > 0").select("lang", F.col("phrase").alias("part"), F.col("f").alias("of_part")), ["lang", "part"])
    # One row tells the whole of its part; another tells a covered part of its cover. Both meet in one aggregate.
    whole = F.struct(F.col("phrase").alias("name"), "size", "a", "start", "len", "of_part", F.lit(False).alias("covered"))
    part = F.struct(F.col("part").alias("name"), F.col("len").alias("size"), F.col("of_part").alias("a"), "start", "len", "of_part",
                    F.lit(True).alias("covered"))
    covers = (F.col("len") >= shortest) & (F.lit(100) * F.col("a") >= F.lit(covered_percent) * F.col("of_part"))
    told = met.select("lang", F.inline(F.when(covers, F.array(whole, part)).otherwise(F.array(whole))))
    own = ~F.col("covered")
    sides = [f(F.when(own & (F.col("start") == start) & (F.col("len") == size), F.col("of_part"))).alias(f"{side}{k}")
             for k in range(1, longest) for f, side, start, size in
             ((F.max, "l", F.lit(0), F.lit(k)), (F.max, "r", F.lit(k), F.col("size") - k))]
    scored = told.groupBy("lang", F.col("name").alias("phrase"), "size", "a").agg(F.bool_or("covered").alias("covered"), *sides)
    cuts = F.array_compact(F.array(*[F.when(F.col("size") > k, F.struct(
        _score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("cut"),
        F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, longest)]))
    ranked = scored.where(~F.col("covered")).select("lang", "phrase", "a", F.array_min(cuts).alias("best")).select("lang", "phrase", "a", "best.*")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = ranked.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("place") <= top)
    first = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")
