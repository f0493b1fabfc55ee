"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from immolytics.llm import phrase_misra_gries as P
from immolytics.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.cases import case_frame


def plain(rows, threshold=10, top=2000):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i:i + size])] += 1
    out = []
    for lang, f in counts.items():
        frequent = {g: a for g, a in f.items() if len(g) > 1 and a >= threshold}
        covered = {g for longer, b in frequent.items() for size in (2,) for i in range(len(longer) - size + 1)
                   if len(longer) > size and 100 * b >= 50 * f[g := longer[i:i + size]]}
        scored = []
        for g, a in frequent.items():
            if g not in covered:
                score, k = min((1000000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def rows_of(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def test_query_equals_plain_counts(spark):
    docs = [(r.lang, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = plain(docs)
    assert len(want) > 100
    assert rows_of(QUERIES["op11_phrase_misra_gries"](spark, SF_SMALL)) == want


def test_small_summaries_and_runs_give_the_same(spark, monkeypatch):
    rng = random.Random(4)
    words = ["a", "B", "été", "x" * 300, "\x00", "d.e", "f\tg", "h\ni"] + [f"w{i}" for i in range(40)]
    docs = [(rng.choice(["en", "fr", None, "und"]), " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 200]))))
            for _ in range(150)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    want = plain(docs, 3)
    assert rows_of(P.collocations(df, threshold=3, partition_bytes=500)) == want
    monkeypatch.setattr(P, "RUN_WORDS", 7)
    monkeypatch.setattr(P, "TASK_ENTRIES", 200)
    task = P._Task(3)
    out = []
    for lang, text in docs:
        ws = P.words_of((text or "").encode())
        for at in range(0, len(ws), 7):
            task.add("all", ws[at:at + 9], min(7, len(ws) - at))
    for lang, keys, counts in task.grams():
        out += zip(task.phrases(keys)[1], counts.tolist())
    whole = Counter()
    for _, text in docs:
        for piece in re.split("[.,;:!?\n]", re.sub("[A-Z]", lambda m: m[0].lower(), text)):
            ws = re.findall("[^ \t]+", piece)
            whole.update(" ".join(ws[i:i + s]) for s in (1, 2, 3) for i in range(len(ws) - s + 1))
    assert Counter(dict(out)) == whole


def test_nulls_long_repeated_empty_and_clashing_columns(spark):
    df = case_frame(spark, phrase="x", rank="y", score="z")
    rows = [(r.lang, r.text) for r in df.collect()]
    assert rows_of(P.collocations(df, threshold=2)) == plain(rows, 2)
    assert rows_of(P.collocations(df.limit(0))) == []
    with pytest.raises(ValueError):
        P.collocations(df, longest=4)


def test_ties_break_by_bytes_and_top_cuts(spark):
    docs = [("en", f"{w} z{w}, " * 12) for w in ("ä", "a", "Z", "z", "zz", "é")]
    df = spark.createDataFrame(docs, "lang string, text string")
    assert rows_of(P.collocations(df, top=4)) == plain(docs, top=4)


def test_merged_summaries_keep_every_frequent_item():
    rng = np.random.default_rng(2)
    for threshold in (3, 10):
        items = np.concatenate([rng.integers(0, 5000, 20000), np.repeat(np.arange(9000, 9040), threshold)]).astype(np.uint64)
        rng.shuffle(items)
        capacity = len(items) // threshold + 1
        hashes, counters, lost = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        for part in np.array_split(items, 13):
            hashes, counters, lost = P.merged(np.concatenate([hashes, part]),
                                              np.concatenate([counters, np.ones(len(part), np.int64)]), lost, capacity)
            assert len(hashes) <= capacity
        true = Counter(items.tolist())
        kept = dict(zip(hashes.tolist(), counters.tolist()))
        assert lost < threshold
        assert all(i in kept and kept[i] <= n <= kept[i] + lost for i, n in true.items() if n >= threshold)


def test_capacity_is_enough_when_counters_are_lowered(spark):
    docs = [("en", " ".join(f"u{i}_{j}" for j in range(300)) + " the common pair.") for i in range(40)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(7)
    assert rows_of(P.collocations(df)) == plain(docs)


def test_scores_are_exact_beyond_64_bits(spark):
    cases = [(10 ** 14 + 7, 10 ** 14 + 9, 10 ** 15 - 1), (3, 7, 9), (10, 10, 10), (999_999_999, 10 ** 12 + 1, 999_999_999)]
    df = spark.createDataFrame(cases, "a long, l long, r long")
    got = [r[0] for r in df.select(P._score(df.a, df.l, df.r)).collect()]
    assert got == [1000000 * a * a // (x * y) for a, x, y in cases]
