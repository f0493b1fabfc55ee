"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is its set of distinct word shingles (64-bit hashes, put in a global
order, rare ones first). Two sets of Jaccard similarity t or more share at least
o = ceil(t * n) shingles, so they share l of the first n - o + l shingles of
each, for any l. Every set picks its l by estimated candidate cost: a longer
prefix costs more look-ups, but asks for more shared shingles before a pair is
verified. Two sets are compared with the smaller l of both.

1. One row per document: its set's key and size. Equal sets are one set from here on.
2. Counts of all shingles in a table of bounded size give the order and the
   costs. They only steer the work: any order and any l give the same result.
3. Prefix shingles held by two sets or more are found by one aggregate. Sets
   that have one travel once, whole, in the global order.
4. Every set meets others at its most shared prefix shingle, or at its two or six
   most shared ones where many hold the first. Small groups
   are compared at once. Of larger ones a leading block meets every block; then
   the sets outside the group's main component meet all others, block by block:
   members of one component need no further comparison. A group compares its
   sets by counting shared prefix shingles, verifies the survivors exactly and
   returns a spanning forest of its links, at most a row per set.
5. Pairs that share other prefix shingles only, and are not yet in one
   component, are joined, counted and verified.
6. Components come from alternating stars (as in SimHash near-duplicates).

Defined cases: null and empty texts have no shingles and link with nothing,
copies of them included; texts of fewer words than a shingle are one shingle;
repeated rows share their component; a null doc_id is a member of its component
but never names it unless all members are null; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import materialize
from .common import append_columns, slices
from .decontaminate_winnow import gram_hashes
from .simhash_vptree import components

SHINGLE = 4
PERCENT = 85
# Largest number of shared shingles that a set may ask for, and look-ups that one verified shingle costs.
MOST_MATCHES, VERIFY = 16, 0.25
# Slots of the count table: one for some 64 shingles, 2**16 to 2**22.
LEAST_BITS, MOST_BITS = 16, 22
# Bits of the map of shared shingles at most.
MAP_BITS = 28
# Sets, and shingles of them, of a block.
BLOCK_SETS, BLOCK_SHINGLES = 512, 1 << 21
# Groups of a set whose most shared shingle is held by at most 1/64 of a block, 1/8 of a block, or more sets.
GROUPS = (1, 2, 6)

# Expected other holders of a shingle that is not known to be common, for the least number of matches.
CHANCE = 0.2
# Bytes of text hashed at a time.
CHUNK = 1 << 22

_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
_FOLDED = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256))
# A number for every byte, equal for A-Z and a-z, and the factor of a byte's place in its word.
_VALUE = np.array([xxhash.xxh64_intdigest(bytes([b])) for b in _FOLDED.tolist()], np.uint64)
_FACTOR = 0x9E3779B97F4A7C15


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the words of some bytes: letters' numbers times powers of a factor, summed and scrambled."""
    starts, hashes, at = [], [], 0
    while at < len(raw):
        end = min(at + CHUNK, len(raw))
        while end < len(raw) and not _SPACE[raw[end]]:                  # up to the end of a word
            more = np.flatnonzero(_SPACE[raw[end:end + CHUNK]])
            end = end + int(more[0]) if len(more) else min(end + CHUNK, len(raw))
        part = raw[at:end]
        letter = ~_SPACE[part]
        edge = np.diff(letter.astype(np.int8), prepend=0, append=0)
        first = np.flatnonzero(edge == 1)
        lengths = np.flatnonzero(edge == -1) - first
        if len(first):
            begun = np.cumsum(lengths) - lengths
            place = np.arange(int(lengths.sum())) - np.repeat(begun, lengths)
            powers = np.cumprod(np.full(int(lengths.max()), _FACTOR, np.uint64))
            total = np.add.reduceat(_VALUE[part[letter]] * powers[place], begun) + lengths.astype(np.uint64)
            total = (total ^ (total >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            starts.append(first + at)
            hashes.append(total ^ (total >> np.uint64(32)))
        at = end
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    joined = np.frombuffer(b" ".join([t or b"" for t in texts]), np.uint8)
    starts, words = word_hashes(joined)
    offsets = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
    bounds = np.searchsorted(starts, offsets).tolist()
    hashes = gram_hashes(words, size, size)
    out = []
    for a, b in zip(bounds, bounds[1:]):
        few = b - a < size
        out.append(np.unique(gram_hashes(words[a:b], b - a, b - a) if few and b > a else hashes[a:max(a, b - size + 1)]))
    return out


def set_keys(hashes: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit hashes of a sorted set."""
    raw = hashes.tobytes()
    return tuple(int(np.uint64(xxhash.xxh64_intdigest(raw, seed)).astype(np.int64)) for seed in (0, 1))


def least_shared(n, percent: int):
    """Shingles that a set of ``n`` shares at least with any set it links with."""
    return -(-percent * n // 100)


def least_matches(n: int, percent: int, most: int) -> int:
    """Matches that a set of ``n`` asks for at least: where chance holders cost as much as a longer prefix. Grows with ``n``."""
    return max(1, min(most, least_shared(n, percent), int(n * (CHANCE * VERIFY * (100 - percent) / 100) ** 0.5)))


def _rows(docs: DataFrame, make, schema: str) -> DataFrame:
    """Rows of ``make()``, a function from some texts (and None at the task's end) to record batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give = make()
        for batch in batches:
            for part in slices(batch, 0):
                yield from give(part.column(0).to_pylist())
        yield from give(None)
    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def count_table(docs: DataFrame, shingle: int, bits: int) -> np.ndarray:
    """Shingles of all documents counted by the first ``bits`` bits of their hash (65,535 at most)."""
    block = min(bits, 16)

    def make():
        total, waiting = np.zeros(1 << bits, np.uint32), []

        def give(texts):
            if texts is not None:
                waiting.extend(s >> np.uint64(64 - bits) for s in shingle_sets(texts, shingle))
            if waiting and (texts is None or sum(map(len, waiting)) > 1 << bits):
                total[:] += np.bincount(np.concatenate(waiting).astype(np.int64), minlength=1 << bits).astype(np.uint32)
                waiting.clear()
            if texts is None:
                parts = np.minimum(total, 65535).astype(np.uint16).reshape(-1, 1 << block)
                used = np.flatnonzero(parts.any(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array([parts[i].view(np.uint8).reshape(-1, 2).T.tobytes() for i in used], pa.binary())],
                    names=["block", "counts"])
        return give

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << block, np.int64)
        for raw in pdf["counts"]:
            total += np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(2, -1).T).view(np.uint16).ravel()
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "counts": [np.minimum(total, 65535).astype(np.uint16).tobytes()]})

    out = np.zeros((1 << (bits - block), 1 << block), np.uint16)
    for row in _rows(docs, make, "block int, counts binary").groupBy("block").applyInPandas(add, "block int, counts binary").collect():
        out[row["block"]] = np.frombuffer(row["counts"], np.uint16)
    return out.ravel()


class Prefixes:
    """Global order, prefix length and number of matches of a set."""

    def __init__(self, table: np.ndarray, noise: int, percent: int, most: int):
        self.table, self.noise, self.percent, self.most = table, noise, percent, most
        self.shift = np.uint64(64 - (len(table) - 1).bit_length())

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
        """(hashes in global order, matches l, whether a hash of the l-prefix may be shared)."""
        n = len(hashes)
        shared = least_shared(n, self.percent)
        counts = self.table[(hashes >> self.shift).astype(np.int64)]
        order = np.lexsort((hashes, counts))
        hashes, counts = hashes[order], counts[order]
        most = min(self.most, shared)
        # Every prefix shingle is looked up and meets its other holders; who may reach l matches is verified.
        others = np.cumsum(np.maximum(0, counts[:n - shared + most].astype(np.int64) - self.noise))[n - shared:]
        cost = np.arange(1, most + 1) + others * (1 + VERIFY * n / np.arange(1, most + 1))
        matches = max(int(np.argmin(cost)) + 1, least_matches(n, self.percent, self.most))
        return hashes, matches, counts[:n - shared + matches] > 1


def levels(n: int, size: int, percent: int) -> np.ndarray:
    """The smallest l whose prefix holds the shingle at each of the first ``size`` places."""
    return np.maximum(1, np.arange(size) - (n - least_shared(n, percent)) + 1)


def bloom(tokens: DataFrame, bits: int) -> np.ndarray:
    """``2**bits`` bits, two set for every ``token``: at most ``2**bits / 64`` rows reach the driver."""
    slots = F.array(F.shiftrightunsigned("token", 64 - bits), F.col("token").bitwiseAND((1 << bits) - 1))
    words = (tokens.select(F.explode(slots).alias("slot")).groupBy(F.shiftright("slot", 6).cast("int").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("mask")).toArrow())
    out = np.zeros(2 ** bits // 64, np.int64)
    out[np.asarray(words["word"])] = np.asarray(words["mask"])
    return out.view(np.uint8)


def in_bloom(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = (8 * len(table) - 1).bit_length()
    found = np.ones(len(hashes), bool)
    for slot in (hashes >> np.uint64(64 - bits), hashes & np.uint64((1 << bits) - 1)):
        found &= (table[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def forest(bodies: list[np.ndarray], matches: np.ndarray, component: np.ndarray, left: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (i, j) that connect what the pairs with a ``left`` set connect, given the components so far.

    A pair is verified if it shares as many prefix shingles as the smaller of
    both ``matches`` asks for, its sizes allow a link and it is not yet connected.
    """
    sizes = np.array([len(b) for b in bodies], np.int64)
    spans = sizes - least_shared(sizes, percent) + matches
    starts = np.concatenate(([0], np.cumsum(sizes)))
    _, ids = np.unique(np.concatenate(bodies), return_inverse=True)
    # Postings of the prefixes, by shingle.
    at = _spread(starts[:-1], spans)
    owner = np.repeat(np.arange(len(bodies)), spans)
    level = np.maximum(1, at - starts[owner] - (sizes - least_shared(sizes, percent))[owner] + 1)
    order = np.argsort(ids[at], kind="stable")
    held, doc, level_of = ids[at][order], owner[order], level[order]
    first = np.searchsorted(held, np.arange(ids.max() + 2 if len(ids) else 1))
    _, label = np.unique(component, return_inverse=True)
    present = np.zeros(ids.max() + 1 if len(ids) else 0, bool)
    out = []
    for i in np.flatnonzero(left):
        mine = ids[starts[i]:starts[i] + spans[i]]
        counts = first[mine + 1] - first[mine]
        met = _spread(first[mine], counts)
        need = np.minimum(matches[i], matches)
        other = doc[met]
        fits = np.maximum(np.repeat(np.maximum(1, np.arange(spans[i]) - (sizes[i] - least_shared(sizes[i], percent)) + 1), counts),
                          level_of[met]) <= need[other]
        shared = np.bincount(other[fits], minlength=len(bodies))
        small, large = np.minimum(sizes, sizes[i]), np.maximum(sizes, sizes[i])
        near = np.flatnonzero((shared >= need) & (label != label[i]) & (100 * small >= percent * large))
        if not len(near):
            continue
        present[ids[starts[i]:starts[i + 1]]] = True
        places = _spread(starts[near], sizes[near])
        common = np.add.reduceat(present[ids[places]].astype(np.int64), np.cumsum(sizes[near]) - sizes[near])
        present[ids[starts[i]:starts[i + 1]]] = False
        for j in near[100 * common >= percent * (sizes[i] + sizes[near] - common)].tolist():
            if label[j] != label[i]:
                out.append((int(i), j))
                label[label == label[j]] = label[i]
    return out


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the runs that begin at ``starts``."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _compared(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of the groups ``group``, ``i``, ``j``: sets marked ``left`` against all of their group."""
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        # A set that stands on both sides is one left set.
        pdf = pdf.sort_values("left", ascending=False, kind="stable").drop_duplicates("set")
        keys = pdf["set"].to_numpy()
        found = forest([np.asarray(b) for b in pdf["body"]], pdf["matches"].to_numpy().astype(np.int64), pdf["comp"].to_numpy(),
                       pdf["left"].to_numpy(), percent)
        return pd.DataFrame({"a": keys[[i for i, _ in found]], "b": keys[[j for _, j in found]]}, dtype="int64")

    return rows.groupBy("group", "i", "j").applyInPandas(compare, "a long, b long")


def _verified(body_a: Column, body_b: Column, percent: int) -> Column:
    common = F.size(F.array_intersect(body_a, body_b))
    return F.lit(100) * common >= F.lit(percent) * (F.size(body_a) + F.size(body_b) - common)


def bodies_of(sent: DataFrame, sets: DataFrame) -> DataFrame:
    """(set, task, matches, body) rows of ``sent`` for the keys in ``sets`` (and some by chance): the others are not shuffled."""
    bits = min(MAP_BITS, max(16, (32 * sets.count()).bit_length()))
    table = sent.sparkSession.sparkContext.broadcast(bloom(sets.select(F.col("set").alias("token")), bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bloom(table.value, np.asarray(batch.column(0)).view(np.uint64))))

    frame = sent.select("set", "task", "matches", "body")
    return frame.mapInArrow(run, frame.schema)


def links(docs: DataFrame, total: int, clash: frozenset[int], shingle: int, percent: int, keys: Callable,
          block_sets: int = BLOCK_SETS, block_shingles: int = BLOCK_SHINGLES, most_matches: int = MOST_MATCHES) -> DataFrame:
    """Links (a, b) between keys of different sets that connect all linked pairs.

    ``total`` is the number of shingles of all documents. Sets whose key is in
    ``clash`` go by their second hash.
    """
    spark = docs.sparkSession
    bits = min(MOST_BITS, max(LEAST_BITS, (total // 64).bit_length()))
    table = spark.sparkContext.broadcast(count_table(docs, shingle, bits))
    chance = total / 2 ** bits
    noise = 1 + int(chance + 3 * chance ** 0.5)                      # what a rare shingle's slot may count

    def prefixes(give_rows):
        def make():
            prefix, seen = Prefixes(table.value, noise, percent, most_matches), set()

            def give(texts):
                rows = []
                for hashes in shingle_sets(texts or [], shingle):
                    if len(hashes):
                        key, check = keys(hashes)
                        key = check if key in clash else key
                        if key not in seen:                          # copies within a task are sent once
                            seen.add(key)
                            rows.append((key, len(hashes), *prefix(hashes)))
                if rows:
                    yield from give_rows(rows)
            return give
        return make

    def tokens(rows):
        kept = [h[:len(may)][may] for _, _, h, _, may in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(kept).view(np.int64)), pa.array(np.repeat([r[0] for r in rows], [len(k) for k in kept]))],
            names=["token", "set"])

    shared = materialize(_rows(docs, prefixes(tokens), "token long, set long").groupBy("token")
                         .agg(F.min("set").alias("lo"), F.max("set").alias("hi"), F.count(F.lit(1)).alias("holders"))
                         .where("lo < hi").select("token", "holders"), "jaccard-shared")
    map_bits = min(MAP_BITS, max(16, (32 * shared.count()).bit_length()))
    known = spark.sparkContext.broadcast(bloom(shared, map_bits))

    def whole(rows):
        held = []
        for key, n, hashes, matches, may in rows:
            at = np.flatnonzero(may)
            at = at[in_bloom(known.value, hashes[at])]
            # Who links with this set is at least as large as what the set must share, and asks for matches accordingly.
            needed = least_matches(least_shared(n, percent), percent, most_matches)
            if len(at) >= needed:
                held.append((key, n, matches, needed, hashes[at].view(np.int64), levels(n, len(may), percent)[at], hashes.view(np.int64)))
        if held:
            key, n, matches, needed, token, level, body = zip(*held)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array(n, pa.int32()), pa.array(matches, pa.int32()), pa.array(needed, pa.int32()),
                 pa.array(token, pa.list_(pa.int64())),
                 pa.array([x.astype(np.int32) for x in level], pa.list_(pa.int32())), pa.array(body, pa.list_(pa.int64()))],
                names=["set", "n", "matches", "needed", "tokens", "levels", "body"])

    sent = _rows(docs, prefixes(whole), "set long, n int, matches int, needed int, tokens array<long>, levels array<int>, body array<long>")
    # A task sends a set once, so set and task name a row; of a set's rows the one of the least task counts. Bodies stay put.
    sent = materialize(sent.withColumn("task", F.spark_partition_id()), "jaccard-sets")
    one = sent.groupBy("set").agg(F.min("task").alias("task"))
    involved = sent.select("set", "task", "n", "matches", "needed", "tokens", "levels").join(one, ["set", "task"])
    met = involved.select("set", "task", "n", "matches", "needed", F.inline(F.arrays_zip("tokens", "levels"))).withColumnsRenamed(
        {"tokens": "token", "levels": "level"}).join(shared, "token")
    # What the map let through by mistake is gone now; sets left with too few shared shingles go too.
    enough = met.groupBy("set").agg(F.count(F.lit(1)).alias("held"), F.first("needed").alias("needed")).where("held >= needed").select("set")
    postings = materialize(met.join(enough, "set").drop("needed"), "jaccard-postings")

    # The most shared prefix shingles of a set are its groups; the more share them, the more of them, so that
    # sets of a large cluster that lack one of them still meet.
    ranked = F.sort_array(F.collect_list(F.struct("holders", "token")), False)
    most = F.col("top")[0]["holders"]
    n_groups = F.when(most > block_sets // 8, GROUPS[2]).when(most > block_sets // 64, GROUPS[1]).otherwise(GROUPS[0])
    chosen = postings.groupBy("set").agg(F.min("task").alias("task"), F.first("n").alias("n"), ranked.alias("top"))
    member = chosen.select("set", "task", "n", F.explode(F.slice("top.token", F.lit(1), n_groups)).alias("group"))
    sized = member.groupBy("group").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    blocks = F.ceil(F.greatest(F.col("sets") / block_sets, F.col("shingles") / block_shingles)).cast("int")
    groups = sized.where("sets > 1").select("group", blocks.alias("blocks"))
    placed = materialize(member.join(groups, "group").withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")),
                         "jaccard-groups")
    # Small groups are one block; of larger ones block 0 meets every block.
    led = placed.withColumn("j", F.explode(F.when(F.col("block") == 0, F.sequence(F.lit(0), F.col("blocks") - 1))
                                           .otherwise(F.array("block"))))
    # A merge join at every size: the sets are too many to be sent to all.
    led = led.join(sent.select("set", "task", "matches", "body").hint("merge"), ["set", "task"]).select("group", F.lit(0).alias("i"), "j", "set", F.col("set").alias("comp"), "matches", "body",
                                         (F.col("block") == 0).alias("left"))
    found = materialize(_compared(led, percent), "jaccard-led")

    if placed.where("blocks > 1").limit(1).count():
        joined = materialize(components(found), "jaccard-components")
        known_comp = placed.where("blocks > 1").join(joined, placed["set"] == joined["node"], "left").select(
            placed["*"], F.coalesce("root", "set").alias("comp"))
        main = (known_comp.groupBy("group", "comp").agg(F.count(F.lit(1)).alias("size"))
                .groupBy("group").agg(F.max_by("comp", F.struct("size", "comp")).alias("main")))
        apart = known_comp.join(main, "group").withColumn("out", F.col("comp") != F.col("main"))
        # Sets outside the main component meet all blocks; blocks of them only, so the main one meets few.
        out_blocks = apart.where("out").groupBy("group").agg(F.ceil(F.count(F.lit(1)) / block_sets).cast("int").alias("outs"))
        spread = apart.join(out_blocks, "group").withColumn("mine", F.pmod(F.xxhash64("set", F.lit(3)), F.col("outs")).cast("int"))
        as_left = F.when(F.col("out"), F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                                                   lambda j: F.struct(F.col("mine").alias("i"), j.alias("j"), F.lit(True).alias("left"))))
        as_right = F.transform(F.sequence(F.lit(0), F.col("outs") - 1),
                               lambda i: F.struct(i.alias("i"), F.col("block").alias("j"), F.lit(False).alias("left")))
        pairs = spread.select("group", "set", "task", "comp", F.inline(F.concat(F.coalesce(as_left, F.filter(as_right, lambda x: F.lit(False))), as_right)))
        pairs = materialize(pairs, "jaccard-apart")
        rest = _compared(pairs.join(bodies_of(sent, pairs.select("set").distinct()), ["set", "task"]).select("group", "i", "j", "set", "comp", "matches", "body", "left"), percent)
        found = materialize(found.unionByName(rest), "jaccard-grouped")

    # Pairs that meet at other shingles only.
    joined = materialize(components(found), "jaccard-components")
    groups_of = placed.groupBy("set").agg(F.collect_list("group").alias("groups"))
    known_comp = (postings.join(joined, postings["set"] == joined["node"], "left")
                  .select(postings["*"], F.coalesce("root", "set").alias("comp")))
    main = (known_comp.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("size"))
            .groupBy("token").agg(F.max_by("comp", F.struct("size", "comp")).alias("main"), F.count(F.lit(1)).alias("comps"))
            .where("comps > 1").select("token", "main"))
    open_postings = materialize(known_comp.join(main, "token").join(groups_of, "set", "left").select(
        "token", "set", "task", "n", "matches", "level", "comp", "main", F.coalesce("groups", F.array().cast("array<long>")).alias("groups")),
        "jaccard-open")
    a, b = open_postings.where("comp <> main").alias("a"), open_postings.alias("b")
    need = F.least("a.matches", "b.matches")
    meets = ((F.col("a.token") == F.col("b.token")) & (F.col("a.comp") != F.col("b.comp"))
             & (F.greatest("a.level", "b.level") <= need) & ~F.arrays_overlap("a.groups", "b.groups")
             & (F.lit(100) * F.least("a.n", "b.n") >= F.lit(percent) * F.greatest("a.n", "b.n"))
             # A pair outside the main component stands on both sides: it is taken once.
             & ((F.col("b.comp") == F.col("b.main")) | (F.col("a.set") < F.col("b.set"))))
    ends = [F.struct(F.col(f"{side}.set").alias("set"), F.col(f"{side}.task").alias("task")) for side in "ab"]
    candidates = materialize(a.join(b, meets).select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b"), need.alias("need"))
                             .groupBy("a", "b").agg(F.count(F.lit(1)).alias("common"), F.first("need").alias("need"))
                             .where("common >= need"), "jaccard-candidates")
    far = candidates.select(F.col("a.set").alias("a"), F.col("a.task").alias("task_a"), F.col("b.set").alias("b"), F.col("b.task").alias("task_b"))
    ends = far.select(F.col("a").alias("set")).union(far.select(F.col("b").alias("set"))).distinct()
    whole_sets = materialize(bodies_of(sent, ends), "jaccard-bodies")
    for side in ("a", "b"):
        far = far.join(whole_sets.select(F.col("set").alias(side), F.col("task").alias(f"task_{side}"), F.col("body").alias(f"body_{side}")),
                       [side, f"task_{side}"])
    far = far.where(_verified(F.col("body_a"), F.col("body_b"), percent)).select("a", "b")
    return found.unionByName(far)


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, keys: Callable = set_keys, **options) -> DataFrame:
    """Per document row: doc_id, n_shingles (size of its set) and component_id (smallest doc_id reachable by links).

    ``keys`` gives two hashes of a set; ``options`` are those of ``links``.
    """
    def make():
        def compute(texts):
            sets = shingle_sets(texts, shingle)
            names = [keys(s) if len(s) else (None, None) for s in sets]
            return [[len(s) for s in sets], [k for k, _ in names], [c for _, c in names]]
        return compute

    fields = [("n", T.LongType()), ("key", T.LongType()), ("check", T.LongType())]
    marked = materialize(append_columns(docs, fields, make), "jaccard-documents")
    # Keys that different sets share by chance (about sets**2 / 2**65 of them) give way to the sets' second hash.
    clash = [r[0] for r in marked.groupBy("key").agg(F.min("check").alias("lo"), F.max("check").alias("hi"))
             .where("lo < hi").select("key").collect()]
    marked = marked.select("doc_id", "n", F.when(F.col("key").isin(clash), F.col("check")).otherwise(F.col("key")).alias("set"))
    edges = links(docs, marked.agg(F.sum("n")).first()[0] or 0, frozenset(clash), shingle, percent, keys, **options)
    joined = materialize(components(edges), "jaccard-components")
    sets = marked.where("n > 0").groupBy("set").agg(F.min("doc_id").alias("doc"))
    named = sets.join(joined, sets["set"] == joined["node"], "left").select("set", "doc", F.coalesce("root", "set").alias("root"))
    smallest = named.groupBy("root").agg(F.min("doc").alias("component"))
    of_set = named.join(smallest, "root").select("set", "component")
    return marked.join(of_set, "set", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))
