"""Unigram language models: the forward algorithm against listed segmentations, and held-out accuracy."""

import numpy as np
import public_tokenizers

from immolytics.llm.lang_unigram import (LONGEST, LanguageModel, Lattices, PieceTable, Scorer, _sampled, fit_languages, identify,
                                         letter_runs, letter_spans, piece_ids, piece_table, run_likelihoods)
from immolytics.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm.cases import CASES, case_frame

PATH = public_tokenizers.path("piece_bpe_32k.model")


def segmentations(text, ids):
    """Every list of piece numbers that spells ``text``; unknown single characters have the last number."""
    if not text:
        yield []
    for j in range(1, len(text) + 1):
        p = ids.get(text[:j], len(ids) if j == 1 else None)
        if p is not None:
            for rest in segmentations(text[j:], ids):
                yield [p] + rest


def test_forward_and_expectations_sum_all_segmentations():
    rng = np.random.default_rng(4)
    ids = {"▁": 0, "▁a": 1, "a": 2, "b": 3, "ab": 4, "ba": 5, "bab": 6, "▁ab": 7}
    p = rng.random((len(ids) + 1, 2))
    spans, counts = ["abab", "a", "bca", "babba"], rng.random((4, 2))
    lattices = Lattices(spans, PieceTable(ids))
    got, uses = np.exp(lattices.likelihood(p)), lattices.expected(p, counts)
    want_uses = np.zeros_like(uses)
    for k, s in enumerate(spans):
        ways = list(segmentations("▁" + s, ids))
        weights = np.array([np.prod(p[w], axis=0) for w in ways])
        assert np.allclose(got[k], weights.sum(axis=0))
        for w, x in zip(ways, weights / weights.sum(axis=0)):
            for piece in w:
                want_uses[piece] += x * counts[k]
    assert np.allclose(uses, want_uses)


def uncut(run, ids, p):
    """Plain forward algorithm over one whole run, rescaled at every letter."""
    text, longest = "▁" + run, max(map(len, ids))
    alpha, logs = [np.ones(p.shape[1])], [np.zeros(p.shape[1])]
    for j in range(1, len(text) + 1):
        total = 0
        for i in range(max(0, j - longest), j):
            piece = ids.get(text[i:j], len(ids) if j == i + 1 else None)
            if piece is not None:
                total = total + np.exp(logs[i] - logs[-1]) * alpha[i] * p[piece]
        logs.append(logs[-1] + np.log(total))
        alpha.append(np.ones(p.shape[1]))
    return logs[-1]


def test_long_runs_are_scored_whole():
    ids, table = piece_ids(PATH), piece_table(PATH)
    assert table.longest == max(map(len, ids)) > 11
    rng = np.random.default_rng(5)
    p = rng.random((len(ids) + 1, 3)) ** 8
    p /= p.sum(axis=0)
    pieces = sorted(q.lstrip("▁") for q in ids if len(q) > 4)
    runs = ["".join(pieces[k] for k in rng.integers(0, len(pieces), n)) for n in (1, 2, 9, 25, 40, 40, 3, 300)]
    runs += ["a" * 200, "语言模型" * 50, "internationalization" * 10, max(pieces, key=len)]
    want = np.array([uncut(r, ids, p) for r in runs])
    assert np.allclose(run_likelihoods(runs, table, p), want, rtol=1e-10)
    assert np.allclose(run_likelihoods(runs, table, p, stretch=50), want, rtol=1e-10)
    assert np.allclose(run_likelihoods(runs, table, p, stretch=1), want, rtol=1e-10)
    assert run_likelihoods([], table, p).shape == (0, 3)


def test_runs_of_many_letters_are_one_word():
    ids = piece_ids(PATH)
    p = np.full((len(ids) + 1, 2), 1e-5)
    p[ids["a"], 1] = p[ids["aa"], 1] = 1e-3
    names, scores = Scorer(LanguageModel(("xx", "yy"), p, PATH))([b"a" * 200_000, "語".encode() * 100_000])
    assert names[0] == "yy" and scores[0] == 1 and names[1] == "xx" and scores[1] == 0.5
    assert letter_runs("aB1c-dé²".encode()) == ["ab", "c", "dé"] and letter_runs("1²".encode()) == []


def test_letter_spans_keep_every_letter():
    assert letter_spans("aB1c-dé²".encode()) == ["ab", "c", "dé"]
    assert "".join(letter_spans(b"q" * 100)) == "q" * 100
    assert max(map(len, letter_spans(b"q" * 100))) == LONGEST


def test_vocabulary_is_letters_only():
    ids = piece_ids(PATH)
    assert len(ids) > 10_000 and all(p == "▁" or p.lstrip("▁").isalpha() for p in ids)


def test_held_out_accuracy(spark):
    rows = QUERIES["op3_language_unigrams"](spark, SF).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
    assert len(rows) == len(langs) and sum(held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_unusual_rows_and_no_labels(spark):
    df = case_frame(spark, lang_pred="clash", score="clash")
    train = spark.createDataFrame([("the river and the house", "en"), ("der Fluss und das Haus", "de"), (None, "fr"),
                                   ("sin idioma", None)], "text string, lang string")
    rows = identify(df, fit_languages(train), keep=("doc_id", "text", "lang_pred")).collect()
    assert len(rows) == len(CASES)
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
        assert r.lang_pred in ("und", "en", "de") and (r.score > 0) == (r.lang_pred != "und")
    assert {r.lang_pred for r in rows if r.doc_id == 5} == {"en"}
    none = identify(df, fit_languages(train.limit(0))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert identify(df.limit(0), fit_languages(train)).collect() == []


def test_sample_counts_copies_once(spark):
    texts = [f"distinct text number {i}" for i in range(2000)]
    for copied in ("the copied text", "another copied text", texts[7]):
        rows = [(t, "xx") for t in texts + [copied] * 1000] + [(copied, "yy")] * 50
        sample, languages = _sampled(spark.createDataFrame(rows, "text string, lang string"), 300)
        picked = [tuple(r) for r in sample.collect()]
        assert languages == ("xx", "yy") and len(picked) == len(set(picked))
        assert (copied, "yy") in picked
        assert abs(sum(lang == "xx" for _, lang in picked) - 300) < 70
