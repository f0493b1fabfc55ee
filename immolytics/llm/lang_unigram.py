"""Language identification with segmentation-marginalised unigram models.

Every language has a probability for each piece of a fixed public vocabulary.
The likelihood of a word is the sum over all its segmentations into pieces,
found by the forward algorithm; that of a text is the product over its words.
Piece probabilities are fitted by expectation-maximisation (forward-backward
over the same lattices) on the word counts of a bounded, hashed sample of
distinct labelled documents (copies count once); each step is a Spark aggregation of expected counts.

Defined cases: null texts and texts without a letter are ``und`` with score 0,
as is everything if no labelled text was given; ties go to the language that
sorts first; runs of letters of any length are scored whole (in stretches that
hand on the state of the forward algorithm, so no segmentation is lost); only the
fit takes runs of more than ``LONGEST`` letters in consecutive spans; repeated
rows get equal results; an empty table gives an empty result; input columns named
like a result are replaced by the result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialize
from .common import append_columns, segment_sums

VOCABULARY = "piece_bpe_32k.model"
UNDETERMINED = "und"
# About so many distinct documents of each language are sampled to fit its model.
FIT_DOCUMENTS = 1000
STEPS = 3
# Longer runs of letters teach in consecutive spans of so many; scoring takes them whole.
LONGEST = 32
SMOOTHING = 0.05
# Cells (positions x runs) of one forward pass, and letters of a stretch of a longer run.
_CELLS = 1 << 17
_STRETCH = 1 << 16
_WORDS_KEPT = 300_000

# Lower-case A-Z; other ASCII bytes but letters separate words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class LanguageModel:
    """Piece probabilities, one row per piece (last: unknown letter), one column per language."""
    languages: tuple[str, ...]
    pieces: np.ndarray
    vocabulary: str


@lru_cache(maxsize=2)
def piece_ids(path: str) -> dict[str, int]:
    """Pieces of letters of the public vocabulary (word starts marked by U+2581), lower case, numbered."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {sp.id_to_piece(i).lower() for i in range(sp.get_piece_size())}
    fit = sorted(p for p in pieces if p.lstrip("▁").isalpha())
    return {p: i for i, p in enumerate(["▁"] + fit)}


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4").astype(np.uint64)


class PieceTable:
    """Piece numbers by hash, one sorted table per piece length, with a filter of the hashes' first 16 bits."""

    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, ids: dict[str, int]):
        self.unknown = len(ids)
        by_length: dict[int, list[tuple[int, int]]] = {}
        for piece, i in ids.items():
            h = np.uint64(0)
            for c in _codes(piece):
                h = np.uint64((int(h) * int(self.BASE) + int(c) * 0xBF58476D1CE4E5B9) & (2 ** 64 - 1))
            by_length.setdefault(len(piece), []).append((int(h), i))
        self.tables, self.longest = {}, max(by_length)
        for length, rows in by_length.items():
            rows.sort()
            hashes = np.array([h for h, _ in rows], np.uint64)
            seen = np.zeros(1 << 16, bool)
            seen[hashes >> np.uint64(48)] = True
            self.tables[length] = hashes, np.array([i for _, i in rows], np.int64), seen

    def look_up(self, length: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indices into ``hashes``, piece numbers) of those that are pieces."""
        if length not in self.tables:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known, numbers, seen = self.tables[length]
        at = np.flatnonzero(seen[hashes >> np.uint64(48)])
        place = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
        match = known[place] == hashes[at]
        return at[match], numbers[place[match]]


@lru_cache(maxsize=2)
def piece_table(path: str) -> PieceTable:
    return PieceTable(piece_ids(path))


def letter_runs(word: bytes) -> list[str]:
    """Runs of letters of a word in lower case."""
    if word.isalpha():                                     # ASCII letters alone
        return [word.decode().lower()]
    text = word.decode("utf-8", "replace").lower()
    return [r for run in _LETTERS.findall(text) if (r := "".join(c for c in run if c.isalpha()))]


def letter_spans(word: bytes) -> list[str]:
    """Letters of a word in lower case, cut into spans of at most ``LONGEST``."""
    return [run[i:i + LONGEST] for run in letter_runs(word) for i in range(0, len(run), LONGEST)]


class Lattices:
    """All segmentations of some spans into pieces, as edges (span, from, to, piece) sorted by ``to``.

    A span begins as a word does, with the mark, unless ``marked`` is false. Sums
    are kept as logarithms, so spans may have any length.
    """

    def __init__(self, spans: list[str], table: PieceTable, marked: bool = True):
        self.n = len(spans)
        self.lengths = np.fromiter(map(len, spans), np.int64, self.n) + marked
        codes = _codes("".join(["▁" + s for s in spans] if marked else spans)) * np.uint64(0xBF58476D1CE4E5B9)
        first = np.cumsum(self.lengths) - self.lengths
        span = np.repeat(np.arange(self.n), self.lengths)
        position = np.arange(len(codes)) - first[span]
        left = self.lengths[span] - position
        self.longest = int(self.lengths.max()) if self.n else 0
        starts, sizes, pieces = [], [], []
        hashes = np.zeros(len(codes) + 1, np.uint64)
        for length in range(1, min(table.longest, self.longest) + 1):
            hashes = hashes[:-1] * PieceTable.BASE + codes[length - 1:]
            inside = np.flatnonzero(left[:len(hashes)] >= length)
            at, piece = table.look_up(length, hashes[inside])
            if length == 1:                                # letters outside the vocabulary
                whole = np.full(len(inside), table.unknown)
                whole[at] = piece
                at, piece = np.arange(len(inside)), whole
            starts.append(inside[at])
            sizes.append(np.full(len(at), length))
            pieces.append(piece)
        start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        stop = position[start] + (np.concatenate(sizes) if sizes else start)
        order = np.argsort(stop.astype(np.int16) if self.longest < 1 << 15 else stop, kind="stable")
        start = start[order]
        self.span, self.start, self.stop = span[start], position[start], stop[order]
        self.piece = (np.concatenate(pieces) if pieces else start)[order]

    def _summed(self, logs: np.ndarray, to: int, near: int, ends: np.ndarray, e, p: np.ndarray) -> None:
        """logs[to] from the edges ``e``, whose far ends are at ``ends``, relative to logs[near]."""
        span = self.span[e]
        made = np.exp(logs[ends[e], span] - logs[near, span]) * p[self.piece[e]]
        for lang in range(p.shape[1]):
            total = np.bincount(span, made[:, lang], self.n)
            np.add(np.log(total, out=np.zeros(self.n), where=total > 0), logs[near, :, lang], out=logs[to, :, lang])

    def forward(self, p: np.ndarray, known: np.ndarray | None = None) -> np.ndarray:
        """alpha[position, span, language]: log of the summed probability of all segmentations up to a position.

        ``known`` holds the first positions' values where a stretch continues a longer run.
        """
        alpha = np.zeros((self.longest + 1, self.n, p.shape[1]))
        done = 1 if known is None else len(known)
        alpha[:done] = 0 if known is None else known
        bounds = np.searchsorted(self.stop, np.arange(self.longest + 2))
        for j in range(done, self.longest + 1):
            self._summed(alpha, j, j - 1, self.start, slice(bounds[j], bounds[j + 1]), p)
        return alpha

    def likelihood(self, p: np.ndarray) -> np.ndarray:
        """log likelihood of every span (rows) in every language."""
        return self.forward(p)[self.lengths, np.arange(self.n)]

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of every piece, given the spans' counts by language."""
        alpha, beta = self.forward(p), np.zeros((self.longest + 1, self.n, p.shape[1]))
        total = alpha[self.lengths, np.arange(self.n)]
        by_start = np.argsort(self.start, kind="stable")
        bounds = np.searchsorted(self.start[by_start], np.arange(0, self.longest + 1))
        for i in range(self.longest - 1, -1, -1):
            self._summed(beta, i, i + 1, self.stop, by_start[bounds[i]:bounds[i + 1]], p)
        share = np.exp(alpha[self.start, self.span] + beta[self.stop, self.span] - total[self.span])
        uses = share * p[self.piece] * counts[self.span]
        return np.stack([np.bincount(self.piece, uses[:, lang], len(p)) for lang in range(p.shape[1])], axis=1)


def _long_likelihood(run: str, table: PieceTable, p: np.ndarray, stretch: int) -> np.ndarray:
    """log likelihood of one run, stretch by stretch; each begins with the last positions of the one before."""
    back = table.longest
    stretch = max(stretch, back)
    alpha = Lattices([run[:stretch]], table).forward(p)
    for at in range(stretch, len(run), stretch):
        alpha = Lattices([run[at - back:at + stretch]], table, marked=False).forward(p, alpha[-back - 1:])
    return alpha[-1, 0]


def run_likelihoods(runs: list[str], table: PieceTable, p: np.ndarray, stretch: int = _STRETCH) -> np.ndarray:
    """log likelihood of every run (rows) in every language: runs of similar length share a pass."""
    lengths = np.fromiter(map(len, runs), np.int64, len(runs))
    found, order = np.zeros((len(runs), p.shape[1])), np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        size = int(lengths[order[at]])
        if size > stretch:
            found[order[at]] = _long_likelihood(runs[order[at]], table, p, stretch)
            at += 1
            continue
        # as many runs as fit at the length of the longest of them
        most = lengths[order[at:at + max(1, _CELLS // (size + 2))]]
        fit = np.flatnonzero((most + 2) * np.arange(1, len(most) + 1) <= _CELLS)
        take = order[at:at + max(1, len(fit) and int(fit[-1]) + 1)]
        take = take[lengths[take] <= stretch]
        found[take] = Lattices([runs[i] for i in take], table).likelihood(p)
        at += len(take)
    return found


def _sampled(labelled: DataFrame, documents: int) -> tuple[DataFrame, tuple[str, ...]]:
    """About ``documents`` hashed distinct documents of each language, and the languages in order."""
    distinct = F.count_distinct(F.xxhash64("text")).alias("n")
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(distinct).collect()}
    if not sizes:
        return labelled, ()
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, documents / n))])
    picked = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)
    return labelled.where(picked).dropDuplicates(["text", "lang"]), tuple(sorted(sizes))


def fit_languages(labelled: DataFrame, documents: int = FIT_DOCUMENTS, vocabulary: str | None = None,
                  steps: int = STEPS) -> LanguageModel:
    """Fit one unigram model per ``lang`` of ``labelled`` (text, lang); null languages and texts teach nothing."""
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path(VOCABULARY)
    known = labelled.select("text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sample, languages = _sampled(known, documents)
    n_pieces = len(piece_ids(vocabulary)) + 1
    pieces = np.full((n_pieces, max(1, len(languages))), 1 / n_pieces)
    if not languages:
        return LanguageModel((), pieces, vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter = Counter()
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in Counter(text.translate(_FOLD).split()).items():
                    for span in letter_spans(word):
                        totals[span, lang] += n
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in totals], pa.string()),
                                          pa.array([x for _, x in totals], pa.string()),
                                          pa.array(list(totals.values()), pa.int64())], names=["span", "lang", "n"])

    spans = materialize(sample.select(F.col("text").cast("binary"), "lang").mapInArrow(count, "span string, lang string, n long")
                        .groupBy("span", "lang").agg(F.sum("n").alias("n")), "language-words")
    column = {lang: i for i, lang in enumerate(languages)}

    for step in range(steps + 1):
        given = spans.sparkSession.sparkContext.broadcast(None if step == 0 else pieces)

        def expect(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            table = piece_table(vocabulary)
            p, total = given.value, np.zeros((n_pieces, len(column)))
            for batch in batches:
                for at in range(0, batch.num_rows, 4096):
                    part = batch.slice(at, 4096)
                    lattices = Lattices(part.column(0).to_pylist(), table)
                    counts = np.zeros((part.num_rows, len(column)))
                    counts[np.arange(part.num_rows), [column[x] for x in part.column(1).to_pylist()]] = part.column(2)
                    if p is None:                          # first every occurrence of a piece counts
                        uses = counts[lattices.span]
                        total += np.stack([np.bincount(lattices.piece, uses[:, i], n_pieces)
                                           for i in range(len(column))], axis=1)
                    else:
                        total += lattices.expected(p, counts)
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(lang, pa.int32()),
                                              pa.array(total[piece, lang])], names=["piece", "lang", "n"])

        found = (spans.mapInArrow(expect, "piece int, lang int, n double").groupBy("piece", "lang")
                 .agg(F.sum("n").alias("n")).toArrow())    # pieces x languages at most
        uses = np.zeros((n_pieces, len(column)))
        uses[np.asarray(found["piece"]), np.asarray(found["lang"])] = np.asarray(found["n"])
        pieces = (uses + SMOOTHING) / (uses + SMOOTHING).sum(axis=0)
    return LanguageModel(languages, pieces, vocabulary)


class Scorer:
    """Posterior over the languages of whole texts; words are scored once and remembered (a bounded number)."""

    def __init__(self, model: LanguageModel):
        self.model, self.table = model, piece_table(model.vocabulary)
        self._forget()

    def _forget(self):
        self.row: dict[bytes, int] = {}
        self.scores = np.zeros((4096, len(self.model.languages)), np.float32)
        self.letters = np.zeros(4096, bool)

    def _learn(self, words: list[bytes]) -> None:
        first = len(self.row)
        while first + len(words) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
        for at in range(0, len(words), 4096):
            part = words[at:at + 4096]
            spans = [letter_runs(w) for w in part]
            lengths = np.fromiter(map(len, spans), np.int64, len(part))
            flat = [s for x in spans for s in x]
            rows = slice(first + at, first + at + len(part))
            self.letters[rows] = lengths > 0
            if flat:
                self.scores[rows] = segment_sums(run_likelihoods(flat, self.table, self.model.pieces),
                                                 np.cumsum(lengths) - lengths, lengths)
        self.row.update(zip(words, range(first, first + len(words))))

    def __call__(self, texts: list[bytes | None]) -> list[list]:
        counts = [Counter((t or b"").translate(_FOLD).split()) for t in texts]
        unseen = list(set().union(*counts).difference(self.row)) if counts else []
        if len(self.row) + len(unseen) > _WORDS_KEPT:
            self._forget()
            unseen = list(set().union(*counts))
        self._learn(unseen)
        lengths = np.fromiter(map(len, counts), np.int64, len(counts))
        total = int(lengths.sum())
        rows = np.fromiter(map(self.row.__getitem__, chain.from_iterable(counts)), np.int64, total)
        n = np.fromiter(chain.from_iterable(c.values() for c in counts), np.float64, total)
        starts = np.cumsum(lengths) - lengths
        has_letters = segment_sums(self.letters[rows].astype(np.int64), starts, lengths) > 0
        if not self.model.languages:
            return [[UNDETERMINED] * len(texts), [0.0] * len(texts)]
        score = segment_sums(self.scores[rows].astype(np.float64) * n[:, None], starts, lengths)
        posterior = np.exp(score - score.max(axis=1, keepdims=True))
        posterior /= posterior.sum(axis=1, keepdims=True)
        best = posterior.argmax(axis=1)
        names = [self.model.languages[b] if h else UNDETERMINED for b, h in zip(best.tolist(), has_letters.tolist())]
        return [names, np.where(has_letters, posterior.max(axis=1), 0.0)]


def identify(docs: DataFrame, model: LanguageModel, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with lang_pred and score (posterior of that language)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return append_columns(docs, [("lang_pred", T.StringType()), ("score", T.DoubleType())],
                          lambda: Scorer(shared.value), keep=keep)
