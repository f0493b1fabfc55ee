"""Quality rules: base counts and the divergence of a document from language references.

The reference of a language holds the shares of its character classes and of its
common words (each at least ``COMMON_SHARE`` of the language's words; all other
words share one bucket), counted over all documents of that language. A document
passes if some reference is near in Jensen-Shannon distance for both histograms.
A histogram of too few characters or words gives no verdict (minimum-length
guard), and neither does an empty set of references.

Defined cases: null and empty texts have no words and fail the base rule; null
languages feed no reference; ties go to the language that sorts first; repeated
rows get equal results; an empty table gives an empty result; input columns named
like a result are replaced by it.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialize
from .common import append_columns, segment_sums

LEAST_WORDS = 20
MOST_REPEATED = 30            # percent of the words
WINDOW = 8
COMMON_SHARE = 0.002
# Jensen-Shannon distances (0 to 1) up to which a histogram is near its reference.
NEAR_CLASSES = 0.30
NEAR_WORDS = 0.50
# Histograms of fewer characters or words give no verdict.
GUARD_CHARACTERS = 200
GUARD_WORDS = 50
_FLUSH = 250_000

SPACE, LINE, OTHER_SPACE, SYMBOL, CONTINUED = 3, 4, 5, 7, 12
CLASSES = 12                  # the bytes that continue a character count nowhere


def _class_table() -> np.ndarray:
    table = np.full(256, 8, np.uint8)                      # other ASCII marks
    table[:32], table[127], table[128:192], table[192:] = 9, 9, CONTINUED, 11
    table[97:123], table[65:91], table[48:58], table[0xC3] = 0, 1, 2, 10
    for group, chars in ((SPACE, b" "), (LINE, b"\n\r"), (OTHER_SPACE, b"\t\x0b\x0c"), (6, b".,;:!?'\"-()"),
                         (SYMBOL, b"#*$%&|<>")):
        table[list(chars)] = group
    return table


_TABLE = _class_table()


def class_counts(raw: bytes) -> np.ndarray:
    return np.bincount(_TABLE[np.frombuffer(raw, np.uint8)], minlength=CLASSES + 1)


def repeated_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = raw.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0
    return sum(n - 1 for line, n in Counter(lines).items() if n > 1 and line.strip())


def repeated_words(texts: list[list[bytes]], window: int = WINDOW) -> np.ndarray:
    """Per text the words inside windows of ``window`` words that occur twice or more in it.

    Windows are compared by a rolling hash and then word by word.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    total = int(lengths.sum())
    if total < window:
        return np.zeros(len(texts), np.int64)
    number = defaultdict(count(1).__next__)
    ids = np.fromiter((i for words in texts for i in map(number.__getitem__, words)), np.uint64, total)
    text = np.repeat(np.arange(len(texts)), lengths)
    n = total - window + 1
    hashes = text[:n].astype(np.uint64)
    for j in range(window):
        hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + ids[j:j + n]
    starts = np.flatnonzero(text[:n] == text[window - 1:])
    order = starts[np.argsort(hashes[starts], kind="stable")]
    a, b = order[:-1], order[1:]
    same = hashes[a] == hashes[b]
    a, b = a[same], b[same]
    equal = text[a] == text[b]
    for j in range(window):
        equal &= ids[a + j] == ids[b + j]
    edges = np.zeros(total + 1, np.int64)
    twice = np.unique(np.concatenate([a[equal], b[equal]]))
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + window, -1)
    covered = (np.cumsum(edges[:-1]) > 0).astype(np.int64)
    return segment_sums(covered, np.cumsum(lengths) - lengths, lengths)


@dataclass(frozen=True)
class References:
    """Shares by language: character classes (rows), and common words with the rest in the last column."""
    languages: tuple[str, ...]
    classes: np.ndarray
    words: dict[bytes, int]
    shares: np.ndarray


def build_references(docs: DataFrame, common_share: float = COMMON_SHARE) -> References:
    """Count classes and words of every document by ``lang`` and keep the common words.

    Tasks add up what they read before the shuffle; at most 1 / ``common_share``
    words per language reach the driver.
    """
    known = docs.select(F.col("text").cast("binary").alias("text"), "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("cls", T.IntegerType()),
                           T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = defaultdict(Counter)
        classes = defaultdict(lambda: np.zeros(CLASSES + 1, np.int64))

        def flushed() -> pa.RecordBatch:
            rows = [(lang, -1, w, n) for lang, c in words.items() for w, n in c.items()]
            rows += [(lang, -2, None, sum(c.values())) for lang, c in words.items()]
            rows += [(lang, i, None, int(n)) for lang, c in classes.items() for i, n in enumerate(c[:CLASSES])]
            words.clear()
            classes.clear()
            columns = list(zip(*rows)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.binary(), pa.int64()))],
                names=["lang", "cls", "word", "n"])

        for batch in batches:
            for raw, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words[lang].update(raw.lower().split())
                classes[lang] += class_counts(raw)
                if sum(map(len, words.values())) > _FLUSH:
                    yield flushed()
        yield flushed()

    counts = materialize(known.mapInArrow(tally, schema).groupBy("lang", "cls", "word").agg(F.sum("n").alias("n")),
                         "divergence-counts")
    totals: dict[str, int] = {}
    classes: dict[str, np.ndarray] = {}
    for r in counts.where("cls <> -1").collect():          # languages x (classes + 1) rows
        if r.cls == -2:
            totals[r.lang] = r.n
        else:
            classes.setdefault(r.lang, np.zeros(CLASSES))[r.cls] = r.n
    languages = tuple(sorted(x for x, n in totals.items() if n))
    if not languages:
        return References((), np.zeros((0, CLASSES)), {}, np.zeros((0, 1)))
    least = F.create_map(*[F.lit(x) for lang in languages for x in (lang, common_share * totals[lang])])
    common = counts.where((F.col("cls") == -1) & (F.col("n") >= least[F.col("lang")])).collect()
    words = {w: i for i, w in enumerate(sorted({bytes(r.word) for r in common}))}
    shares = np.zeros((len(languages), len(words) + 1))
    for r in common:
        shares[languages.index(r.lang), words[bytes(r.word)]] = r.n / totals[r.lang]
    shares[:, -1] = 1 - shares[:, :-1].sum(axis=1)
    return References(languages, np.stack([classes[x] / classes[x].sum() for x in languages]), words, shares)


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (root of the divergence in bits, 0 to 1) along the last axis."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return np.sqrt(np.clip(parts.sum(axis=-1) / 2, 0, 1))


def _maker(shared):
    def make():
        refs: References = shared.value
        common = refs.shares[:, :-1] > 0

        def distances(words: list[list[bytes]], raws: list[bytes], classes: np.ndarray):
            """Distances (documents x languages) of the class and word histograms."""
            shares = classes / np.maximum(1, classes.sum(axis=1, keepdims=True))
            of_class = jensen_shannon(shares[:, None, :], refs.classes[None])
            of_word = np.ones_like(of_class)
            look = refs.words.get
            for i, raw in enumerate(raws):
                found = Counter(map(look, raw.lower().split()))
                found.pop(None, None)
                n = max(1, len(words[i]))
                at = np.fromiter(found.keys(), np.int64, len(found))
                share = np.fromiter(found.values(), np.float64, len(found)) / n
                for lang in range(len(refs.languages)):
                    own = common[lang, at]
                    p, q = share[own], refs.shares[lang, at[own]]
                    rest = np.array([1 - p.sum()]), refs.shares[lang, -1:]
                    unseen = 1 - q.sum() - refs.shares[lang, -1]   # common words the text lacks
                    p, q = np.concatenate([p, rest[0], [0.0]]), np.concatenate([q, rest[1], [max(0.0, unseen)]])
                    of_word[i, lang] = jensen_shannon(p, q)
            return of_class, of_word

        def compute(texts):
            raws = [t or b"" for t in texts]
            words = [r.split() for r in raws]
            counts = np.stack([class_counts(r) for r in raws])
            n_words = np.fromiter(map(len, words), np.int64, len(words))
            spaces = counts[:, SPACE] + counts[:, LINE] + counts[:, OTHER_SPACE]
            classes = counts[:, :CLASSES]
            characters = classes.sum(axis=1)
            repeat = repeated_words(words)
            failed = (n_words < LEAST_WORDS) | (100 * repeat > MOST_REPEATED * n_words)
            if refs.languages:
                of_class, of_word = distances(words, raws, classes)
                fine = ((of_class <= NEAR_CLASSES) | (characters < GUARD_CHARACTERS)[:, None])
                fine &= (of_word <= NEAR_WORDS) | (n_words < GUARD_WORDS)[:, None]
                best = np.where(fine, of_class + of_word, 9 + of_class + of_word).argmin(axis=1)
                rows = np.arange(len(raws))
                verdict, of_class, of_word = fine.any(axis=1), of_class[rows, best], of_word[rows, best]
                names = [refs.languages[b] for b in best.tolist()]
            else:
                verdict, names = np.ones(len(raws), bool), [None] * len(raws)
                of_class = of_word = np.zeros(len(raws))
            return [n_words, characters - spaces, counts[:, SYMBOL], [repeated_lines(r) for r in raws], repeat, failed,
                    ~failed & verdict, names, of_class, of_word]
        return compute
    return make


def divergence_rules(docs: DataFrame, references: References, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with the base counts, base_failed, kept, and the nearest reference.

    ``class_distance`` and ``word_distance`` are measured against ``reference``, the
    nearest language that passes (or the nearest of all).
    """
    shared = docs.sparkSession.sparkContext.broadcast(references)
    fields = [(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    fields += [("base_failed", T.BooleanType()), ("kept", T.BooleanType()), ("reference", T.StringType()),
               ("class_distance", T.DoubleType()), ("word_distance", T.DoubleType())]
    return append_columns(docs, fields, _maker(shared), keep=keep)
