"""Quality classifier: a factorisation machine over hashed words, structure statistics and length.

score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise
term is computed in linear time, as half of the sum over factors of
(sum_i v_if x_i)^2 - sum_i (v_if x_i)^2. The model is fitted on a bounded, hashed
sample of labelled documents; every document is scored from its whole text.

Defined cases: null and empty texts are scored from their (zero) statistics;
without labelled rows every score is 0.5; repeated rows get equal scores; an
empty table gives an empty result; input columns named like a result are
replaced by it.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .common import Memo, append_columns, labelled_sample, segment_sums

# Labelled documents that the model is fitted on, at most.
FIT_DOCUMENTS = 8192
WORD_SLOTS = 1 << 14
BUCKETS = 16
STATISTICS = 16
SLOTS = WORD_SLOTS + BUCKETS * STATISTICS
FACTORS = 8
EPOCHS = 12
THRESHOLD = 0.3

_ALL = bytes(range(256))


def _others(wanted: bytes) -> bytes:
    """The bytes to delete so that only ``wanted`` ones are left."""
    return bytes(set(_ALL) - set(wanted))


_UPPER, _DIGITS = _others(bytes(range(65, 91))), _others(b"0123456789")
_SYMBOLS, _SHOUTS, _STOPS = _others(b"#*$%&|<>{}[]^~_=\\/@"), _others(b"!?"), _others(b".,;:")
_BEYOND = _others(bytes(range(128, 256)))


def statistics(raw: bytes, counts: Counter) -> list[float]:
    """Structure statistics of a text, each at least 0."""
    size, words = len(raw), sum(counts.values())
    lines = [x for x in raw.split(b"\n") if x]
    per_byte, per_word = 1 / max(1, size), 1 / max(1, words)
    return [
        math.log2(1 + size) / 2, math.log2(1 + words),                       # length (metadata)
        size * per_word, 15 * len(counts) * per_word,
        30 * max(counts.values(), default=0) * per_word,
        15 * sum(n for n in counts.values() if n > 1) * per_word,
        math.log2(1 + len(lines)), 15 * (1 - len(set(lines)) / max(1, len(lines))),
        math.log2(1 + words / max(1, len(lines))),
        30 * len(raw.translate(None, _UPPER)) * per_byte, 60 * len(raw.translate(None, _DIGITS)) * per_byte,
        60 * len(raw.translate(None, _SYMBOLS)) * per_byte, 60 * len(raw.translate(None, _SHOUTS)) * per_byte,
        100 * len(raw.translate(None, _STOPS)) * per_byte, 30 * len(raw.translate(None, _BEYOND)) * per_byte,
        2 * math.log2(1 + raw.count(b"http") + raw.count(b"www.")),
    ]


def make_features():
    """Task function: (slots, values, number of features) of texts; words by hash, statistics by bucket."""
    slot = Memo(lambda word: xxhash.xxh3_64_intdigest(word) % WORD_SLOTS)

    def features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slots, values, lengths = [], [], []
        for raw in texts:
            raw = raw or b""
            counts = Counter(raw.lower().split())
            n = len(counts)
            weight = np.log1p(np.fromiter(counts.values(), np.float64, n))
            values.append(weight / max(1e-9, math.sqrt(float(weight @ weight))))
            slots.append(np.fromiter(map(slot.__getitem__, counts), np.int64, n))
            stats = np.minimum(np.asarray(statistics(raw, counts)), BUCKETS - 1).astype(np.int64)
            slots.append(WORD_SLOTS + np.arange(STATISTICS) * BUCKETS + stats)
            values.append(np.full(STATISTICS, 0.5))
            lengths.append(n + STATISTICS)
        return np.concatenate(slots), np.concatenate(values), np.asarray(lengths)
    return features


@dataclass(frozen=True)
class FactorisationMachine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def logits(self, slots: np.ndarray, values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Linear-time scores through the sum-of-squares identity."""
        starts = np.cumsum(lengths) - lengths
        scaled = self.factors[slots] * values[:, None].astype(np.float32)
        sums = segment_sums(scaled, starts, lengths).astype(np.float64)
        squares = segment_sums((scaled * scaled).sum(axis=1).astype(np.float64), starts, lengths)
        linear = segment_sums(self.linear[slots] * values, starts, lengths)
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares)


def fit_machine(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> FactorisationMachine:
    """Logistic loss, Adagrad, mini-batches; ``rows`` are (slots, values) per document."""
    rng = np.random.default_rng(seed)
    linear, factors = np.zeros(SLOTS), (0.05 * rng.standard_normal((SLOTS, FACTORS))).astype(np.float32)
    if not len(labels):
        return FactorisationMachine(0.0, linear, np.zeros_like(factors))
    share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    bias, g_linear, g_factors = math.log(share / (1 - share)), np.full(SLOTS, 1e-4), np.full(SLOTS, 1e-4)
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), 128):
            batch = order[at:at + 128]
            slots = np.concatenate([rows[i][0] for i in batch])
            values = np.concatenate([rows[i][1] for i in batch])
            lengths = np.asarray([len(rows[i][0]) for i in batch])
            starts = np.cumsum(lengths) - lengths
            machine = FactorisationMachine(bias, linear, factors)
            error = 1 / (1 + np.exp(-machine.logits(slots, values, lengths))) - labels[batch]
            of_row = np.repeat(error, lengths)
            sums = segment_sums(factors[slots] * values[:, None].astype(np.float32), starts, lengths)
            d_linear = of_row * values
            d_factors = d_linear[:, None] * (np.repeat(sums, lengths, axis=0) - factors[slots] * values[:, None])
            used, place = np.unique(slots, return_inverse=True)
            down = np.bincount(place, d_linear) / len(batch) + 1e-5 * linear[used]
            down_f = np.stack([np.bincount(place, d_factors[:, f]) for f in range(FACTORS)], axis=1) / len(batch)
            down_f += 1e-5 * factors[used]
            g_linear[used] += down * down
            g_factors[used] += (down_f * down_f).mean(axis=1)
            linear[used] -= 0.1 * down / np.sqrt(g_linear[used])
            factors[used] -= (0.05 * down_f / np.sqrt(g_factors[used])[:, None]).astype(np.float32)
            bias -= 0.02 * float(error.mean())
    return FactorisationMachine(bias, linear, factors)


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", documents: int = FIT_DOCUMENTS,
                folds: int = 5) -> FactorisationMachine:
    """Fit on at most ``documents`` labelled rows whose fold (crc32 of doc_id) is not 0.

    Features are made in the tasks; the driver receives the sparse rows of the
    bounded sample and fits the fixed-size model.
    """
    sample = labelled_sample(docs, labels, label, documents, folds)

    def make():
        features = make_features()

        def compute(texts):
            slots, values, lengths = features(texts)
            cuts = np.cumsum(lengths)[:-1]
            return [[x.astype("<i4").tobytes() for x in np.split(slots, cuts)],
                    [x.astype("<f4").tobytes() for x in np.split(values, cuts)]]
        return compute

    got = append_columns(sample, [("slots", T.BinaryType()), ("values", T.BinaryType())], make,
                         keep=("doc_id", "__label")).orderBy("doc_id").toArrow()
    rows = [(np.frombuffer(s, "<i4").astype(np.int64), np.frombuffer(v, "<f4").astype(np.float64))
            for s, v in zip(got["slots"].to_pylist(), got["values"].to_pylist())]
    return fit_machine(rows, np.asarray(got["__label"], dtype=np.float64))


def score_quality(docs: DataFrame, machine: FactorisationMachine, threshold: float = THRESHOLD,
                  keep=("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with score (probability of label 1) and predicted (score >= threshold)."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def make():
        features = make_features()

        def compute(texts):
            return [1 / (1 + np.exp(-np.clip(shared.value.logits(*features(texts)), -30, 30)))]
        return compute

    return append_columns(docs, [("score", T.DoubleType())], make, keep=keep).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
