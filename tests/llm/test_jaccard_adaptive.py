"""Jaccard join against comparing all pairs of sets."""

import random
import re

import numpy as np
import pytest

from immolytics.llm import jaccard_adaptive as J
from tests.llm.cases import case_frame


def shingles(text, size=4):
    words = re.findall("[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def plain(docs, percent=85):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    names = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            names[find(i)] = min(doc, names.get(find(i), doc))
    return sorted(((doc, len(sets[i]), names.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(docs)), key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def copies(rng, n_docs, groups):
    """Prose over a small vocabulary, and groups of copies that differ in some words; a passage that many share."""
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(words, k=30))
    texts = [" ".join(rng.choices(words, k=rng.choice([1, 2, 3, 5, 30, 90]))) for _ in range(n_docs)]
    texts += [passage + " " + " ".join(rng.choices(words, k=rng.choice([1, 4, 12]))) for _ in range(n_docs // 2)]
    for size in groups:
        base = rng.choices(words, k=rng.choice([40, 100]))
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("options", [{}, {"block_sets": 4}, {"most_matches": 1}])
def test_equals_comparing_all_pairs(spark, options):
    docs = copies(random.Random(7), 60, [2, 3, 9, 60])
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = plain(docs)
    assert len({c for _, _, c in want}) < len(docs) - 30
    assert rows_of(J.jaccard_components(df, **options)) == want


def test_nulls_empty_repeated_long_and_clashing_columns(spark):
    df = case_frame(spark, key="k", n="n", set="s", component_id="c")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    docs += [(None, "no id here"), (20, "No ID here"), (21, ""), (22, "no id"), (None, None)]
    more = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(J.jaccard_components(more)) == plain(docs)
    assert rows_of(J.jaccard_components(df)) == plain([(r.doc_id, r.text) for r in df.collect()])
    assert rows_of(J.jaccard_components(df.limit(0))) == []


def test_sets_of_one_key_stay_apart(spark):
    docs = copies(random.Random(2), 30, [4])
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)

    def few_keys(hashes):
        key, check = J.set_keys(hashes)
        return key % 40, check

    assert rows_of(J.jaccard_components(df, keys=few_keys)) == plain(docs)


def test_prefixes_of_any_length_share_enough():
    rng = np.random.default_rng(1)
    for percent in (50, 85):
        table = rng.integers(0, 300, 1 << 16).astype(np.uint16)
        for trial in range(300):
            base = rng.integers(0, 1 << 63, rng.integers(1, 60)).astype(np.uint64)
            pair = [np.unique(np.concatenate([base, rng.integers(0, 1 << 63, rng.integers(0, 9)).astype(np.uint64)])) for _ in range(2)]
            common = len(np.intersect1d(*pair))
            if 100 * common < percent * (len(pair[0]) + len(pair[1]) - common):
                continue
            prefixes = [J.Prefixes(table, noise, percent, 8)(h) for noise, h in zip((1, 250), pair)]
            least = min(m for _, m, _ in prefixes)
            heads = [h[:len(h) - J.least_shared(len(h), percent) + least] for h, _, _ in prefixes]
            assert len(np.intersect1d(*heads)) >= least
            for h, m, may in prefixes:
                assert len(may) == len(h) - J.least_shared(len(h), percent) + m
                level = J.levels(len(h), len(may), percent)
                assert all((level <= k).sum() == len(h) - J.least_shared(len(h), percent) + k for k in range(1, m + 1))


def test_costly_prefixes_are_longer():
    table = np.ones(1 << 16, np.uint16)
    hashes = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 200).astype(np.uint64) * np.uint64(2))
    assert J.Prefixes(table, 1, 85, 8)(hashes[:20])[1] == 1
    assert J.Prefixes(table * 500, 1, 85, 8)(hashes[:20])[1] > 1
    assert J.Prefixes(table, 1, 85, 8)(hashes)[1] == J.least_matches(len(hashes), 85, 8) == 8


def test_word_hashes_do_not_depend_on_chunks(monkeypatch):
    texts = [b"One two  THREE four\tfive", None, b"", b"x" * 50 + b" y", b"\xc3\x89t\xc3\xa9 a b", b" \n "]
    whole = [s.tolist() for s in J.shingle_sets(texts, 2)]
    assert [len(s) for s in whole] == [4, 0, 0, 1, 2, 0]
    assert J.shingle_sets([b"one TWO three four five"], 2)[0].tolist() == whole[0]
    for chunk in (1, 3, 7):
        monkeypatch.setattr(J, "CHUNK", chunk)
        assert [s.tolist() for s in J.shingle_sets(texts, 2)] == whole
    rng = random.Random(1)
    words = list({"".join(rng.choices("abAB", k=rng.randrange(1, 9))) for _ in range(5000)})
    hashes = J.word_hashes(np.frombuffer(" ".join(words).encode(), np.uint8))[1]
    assert len(hashes) == len(words) and len(set(hashes.tolist())) == len({w.lower() for w in words})


def test_bloom_holds_all(spark):
    tokens = np.random.default_rng(2).integers(-2 ** 63, 2 ** 63 - 1, 500)
    table = J.bloom(spark.createDataFrame([(int(t),) for t in tokens], "token long"), 16)
    assert J.in_bloom(table, tokens.view(np.uint64)).all()
    assert J.in_bloom(table, np.arange(1000).astype(np.uint64) << np.uint64(40)).mean() < 0.1
