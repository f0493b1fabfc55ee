"""Best-fit packing of token sequences by hierarchical residual packing.

Every partition packs its own pieces best-fit (longest first). Bins that could
not even take the least filled bin are final. The others become items of the
next round: groups of underfull bins are packed best-fit again, and so on up the
tree until no two bins fit into one. Only (bin, fill) pairs of underfull bins
travel between rounds, never token ids.

Defined cases: null and empty texts are one end token (id 0); repeated rows and
ties are packed row by row; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import materialize
from .common import quoted, slices

CAPACITY = 2048
END_ID = 0
VOCABULARY = "word_bpe_49k.json"
# Pieces that a task packs at a time, and items of one group of a merge round.
BLOCK = 65_536
_CACHED_WORD = 48
_CACHE_LIMIT = 800_000
# A final stop or comma after a letter; a chunk of letters (or bytes beyond ASCII) and ASCII marks
# after them; Latin letters that stay one letter when lower-cased.
_FINAL_MARK = re.compile(rb"(?<=[A-Za-z])[.,](?!\S)")
_WORD_AND_MARKS = re.compile(rb"([a-z\x80-\xff]+)([!-/:-@\[-`{-~]*)").fullmatch
_LATIN = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e]+").fullmatch


def _chunks(raw: bytes) -> list[bytes]:
    """White-space-free chunks with the token ids of the text: ASCII folded, final stops and commas apart.

    Special tokens are told by case, so a text that may hold one is not folded.
    """
    if b"<|" not in raw:
        raw = raw.lower()
    return _FINAL_MARK.sub(rb" \g<0>", raw).split()


class TokenIds:
    """Token ids of whole texts as little-endian uint32 bytes.

    No token of the vocabulary spans ASCII white space and the normaliser acts
    on each white-space-free chunk alone, so chunks are encoded once and
    remembered (a bounded number of them). The pre-tokenizer parts letters from
    the marks after them and case is folded, so the letters of a chunk are
    looked up apart from its final marks; unseen Latin words are encoded many at
    a time and cut at the tokens that end a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends_word[i] = token.endswith("</w>")
        self.known: dict[bytes, bytes] = {}

    def _each(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        found = self.tokenizer.encode_batch_fast([c.decode("utf-8", "replace") for c in chunks],
                                                 add_special_tokens=False)
        return {c: np.asarray(e.ids, "<u4").tobytes() for c, e in zip(chunks, found)}

    def _together(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of Latin words, each one pre-token: encoded as one text, cut after every word end."""
        ids = np.asarray(self.tokenizer.encode(b" ".join(words).decode(), add_special_tokens=False).ids, "<u4")
        stops = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
        if len(stops) != len(words):
            return self._each(words)
        buffer = ids.tobytes()
        return {w: buffer[a:b] for w, a, b in zip(words, [0] + stops, stops)}

    def _learn(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        words, parts, others = [], [], []
        for c in chunks:
            if c.isalpha():                                # ASCII letters alone
                words.append(c)
            elif (found := _WORD_AND_MARKS(c)) and _LATIN(found[1].decode("utf-8", "replace")):
                parts.append((c, found[1], found[2]))
            else:
                others.append(c)
        fresh = self._each(others)
        known = self.known.get
        unseen = {w for _, w, _ in parts if w not in self.known}.difference(words)
        words += unseen
        for at in range(0, len(words), 2048):
            fresh.update(self._together(words[at:at + 2048]))
        after = self._each(list({tail for _, _, tail in parts if tail}))
        after[b""] = b""
        for c, word, tail in parts:
            fresh[c] = (known(word) or fresh[word]) + after[tail]
        return fresh

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        chunks = [_chunks(t or b"") for t in texts]
        look = self.known.get
        found = [list(map(look, c)) for c in chunks]
        unseen = {c for names, ids in zip(chunks, found) if None in ids for c, i in zip(names, ids) if i is None}
        if len(self.known) + len(unseen) > _CACHE_LIMIT:
            self.known = {}
        fresh = self._learn(unseen)
        look = fresh.__getitem__
        out = [b"".join(ids) if None not in ids else
               b"".join([look(c) if i is None else i for c, i in zip(names, ids)]) for names, ids in zip(chunks, found)]
        self.known.update((c, i) for c, i in fresh.items() if len(c) <= _CACHED_WORD)
        return out


_ENCODERS: dict[str, TokenIds] = {}


def encoder(path: str) -> TokenIds:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TokenIds(path)
    return _ENCODERS[path]


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Best-fit decreasing: (bin, offset) per item and the fill of every bin.

    Bins are kept by free space; a bit mask of the free spaces in use finds the
    tightest bin that still takes an item.
    """
    place, offset, fill = [0] * len(sizes), [0] * len(sizes), []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        size = sizes[i]
        fitting = mask >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                mask &= ~(1 << free)
        else:
            free, b = capacity, len(fill)
            fill.append(0)
        place[i], offset[i] = b, fill[b]
        fill[b] += size
        free -= size
        if free:
            by_free[free].append(b)
            mask |= 1 << free
    return place, offset, fill


def _locally_packed(docs: DataFrame, path: str, capacity: int, block: int) -> DataFrame:
    """One row per piece: its bin of the task that made it, its place there and that bin's fill."""
    frame = docs.select(F.col(quoted("doc_id")), F.col(quoted("text")).cast("binary").alias("__text"))
    schema = T.StructType([
        frame.schema["doc_id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        T.StructField("bin", T.LongType()), T.StructField("offset", T.LongType()),
        T.StructField("fill", T.LongType())])
    arrow = to_arrow_schema(schema)
    end = np.asarray([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, first = encoder(path), TaskContext.get().partitionId() << 36
        rows: list[list] = [[] for _ in range(5)]

        def packed() -> pa.RecordBatch:
            nonlocal first, rows
            place, offset, fill = best_fit(rows[3], capacity)
            out = rows + [[first + b for b in place], offset, [fill[b] for b in place]]
            first += len(fill)
            rows = [[] for _ in range(5)]
            return pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(out, arrow)], schema=arrow)

        for batch in batches:
            for part in slices(batch, 1):
                for doc, buffer in zip(part.column(0).to_pylist(), ids.encode(part.column(1).to_pylist())):
                    buffer += end
                    n = len(buffer) // 4
                    for piece, start in enumerate(range(0, n, capacity)):
                        cut = buffer[4 * start:4 * (start + capacity)]
                        for column, value in zip(rows, (doc, piece, start, len(cut) // 4, zlib.crc32(cut))):
                            column.append(value)
                if len(rows[0]) >= block:
                    yield packed()
        if rows[0]:
            yield packed()

    return frame.mapInArrow(run, schema)


def _merge_round(bins: DataFrame, groups: int, seed: int, capacity: int) -> DataFrame:
    """Underfull bins packed best-fit within hashed groups: (bin, parent, shift, fill of the parent)."""
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["fill", "bin"], ascending=[False, True], ignore_index=True)
        place, shift, fill = best_fit(pdf["fill"].tolist(), capacity)
        ids, parent = pdf["bin"].tolist(), {}
        for b, i in zip(place, ids):                       # the first item of a bin names it
            parent.setdefault(b, i)
        return pd.DataFrame({"bin": ids, "parent": [parent[b] for b in place], "shift": shift,
                             "fill": [fill[b] for b in place]})

    group = F.pmod(F.xxhash64("bin", F.lit(seed)), F.lit(groups))
    return (bins.withColumn("group", group).groupBy("group")
            .applyInPandas(merge, "bin long, parent long, shift long, fill long"))


def _open_bins(bins: DataFrame, capacity: int) -> tuple[Column, int]:
    """Condition on ``fill`` of the bins that can take the least filled one, and their number.

    No other bin can take or join one, now or after merges (fills only grow).
    """
    counts = {r["fill"]: r["n"] for r in bins.groupBy("fill").agg(F.count("*").alias("n")).collect()}
    most = capacity - min(counts, default=0)
    return F.col("fill") <= most, sum(n for fill, n in counts.items() if fill <= most)


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY,
                   block: int = BLOCK) -> DataFrame:
    """Pack the documents of ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id and offset. Documents longer than the capacity are cut, no
    others. The piece table is written once to the shared folder; merge rounds
    read only the fills of its underfull bins.
    """
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path(VOCABULARY)
    pieces = materialize(_locally_packed(docs, tokenizer_path, capacity, block), "pack-pieces")
    bins = pieces.where(F.col("offset") == 0).select("bin", "fill")
    is_open, left = _open_bins(bins, capacity)
    bins, moves, seed = bins.where(is_open), None, 0
    while left > 1:                                        # the least filled bin fits into any other one
        merged = materialize(_merge_round(bins, -(-left // block), seed, capacity), "pack-merge")
        step = merged.select("bin", "parent", "shift")
        if moves is None:
            moves = step
        else:
            later = step.select(F.col("bin").alias("parent"), F.col("parent").alias("__next"),
                                F.col("shift").alias("__more"))
            moves = materialize(
                moves.join(later, "parent", "left")
                .select("bin", F.coalesce("__next", "parent").alias("parent"),
                        (F.col("shift") + F.coalesce("__more", F.lit(0))).alias("shift")), "pack-moves")
        bins = merged.where(F.col("bin") == F.col("parent")).select("bin", "fill")
        still_open, left = _open_bins(bins, capacity)
        bins, seed = bins.where(still_open), seed + 1
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if moves is None:
        return pieces.select(*columns, F.col("bin").alias("sequence_id"), "offset")
    final = pieces.where(~is_open).select(*columns, F.col("bin").alias("sequence_id"), "offset")
    moved = (pieces.where(is_open).join(moves, "bin")
             .select(*columns, F.col("parent").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset")))
    return final.unionByName(moved)
