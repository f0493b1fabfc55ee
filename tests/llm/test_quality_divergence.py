"""Base counts and Jensen-Shannon verdicts against plain re-computation."""

import math
import re
from collections import Counter

import numpy as np

from immolytics.llm import quality_divergence as Q
from immolytics.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.cases import CASES, case_frame


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            hit.update(range(i, i + 8))
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed)


def got(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_base_counts_of_the_query(spark):
    rows = QUERIES["op6_divergence_rules"](spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert {r.doc_id: got(r) for r in rows} == {d: plain(t) for d, t in texts.items()}
    assert all(not (r.kept and r.base_failed) for r in rows) and any(r.kept for r in rows)


def test_references_and_verdicts_equal_plain_computation(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    refs = Q.build_references(df)
    table = {}
    for lang in sorted({x for _, _, x in docs}):
        raws = [t.encode() for _, t, x in docs if x == lang]
        classes = sum(Q.class_counts(r) for r in raws)[:Q.CLASSES]
        words = Counter(w for r in raws for w in r.lower().split())
        n = sum(words.values())
        table[lang] = (classes / classes.sum(), {w: c / n for w, c in words.items() if c >= Q.COMMON_SHARE * n})
    assert refs.languages == tuple(table)
    for i, lang in enumerate(table):
        assert np.allclose(refs.classes[i], table[lang][0])
        have = {w: refs.shares[i, j] for w, j in refs.words.items() if refs.shares[i, j] > 0}
        assert have.keys() == table[lang][1].keys() and all(math.isclose(have[w], table[lang][1][w]) for w in have)

    def distance(p, q):
        total = 0.0
        for k in p.keys() | q.keys():
            a, b = p.get(k, 0), q.get(k, 0)
            total += sum(x * math.log2(2 * x / (a + b)) for x in (a, b) if x > 0)
        return math.sqrt(min(1, max(0, total / 2)))

    for r in Q.divergence_rules(df, refs, keep=("doc_id",)).collect():
        raw = next(t for d, t, _ in docs if d == r.doc_id).encode()
        classes, counts = Q.class_counts(raw)[:Q.CLASSES], Counter(raw.lower().split())
        n, verdicts = max(1, sum(counts.values())), []
        for ref, words in table.values():
            c = distance(dict(enumerate(classes / max(1, classes.sum()))), dict(enumerate(ref)))
            p = {w: counts[w] / n for w in words if w in counts}
            p[None], q = 1 - sum(p.values()), {**words, None: 1 - sum(words.values())}
            w = distance(p, q)
            verdicts.append(((c <= Q.NEAR_CLASSES or classes.sum() < Q.GUARD_CHARACTERS)
                             and (w <= Q.NEAR_WORDS or n < Q.GUARD_WORDS), c, w))
        assert r.kept == (not r.base_failed and any(v for v, _, _ in verdicts))
        assert any(abs(c - r.class_distance) < 1e-6 and abs(w - r.word_distance) < 1e-6 for _, c, w in verdicts)


def test_unusual_rows(spark):
    df = case_frame(spark, kept="clash", reference="clash")
    refs = Q.build_references(df.withColumn("lang", Q.F.when(Q.F.col("doc_id") > 6, None).otherwise("en")))
    rows = Q.divergence_rules(df, refs, keep=("doc_id", "kept")).collect()
    assert sorted(map(str, ((r.doc_id,) + got(r) for r in rows))) == sorted(map(str, ((d,) + plain(t) for d, t in CASES)))
    none = Q.build_references(df.limit(0))
    rows = Q.divergence_rules(df, none).collect()
    assert none.languages == () and all(r.kept == (not r.base_failed) for r in rows)
    assert Q.divergence_rules(df.limit(0), refs).collect() == []


def test_repeats_across_texts_do_not_count():
    words = "a b c d e f g h i j".encode().split()
    assert Q.repeated_words([words, words, words + words, [], words[:3]]).tolist() == [0, 0, 20, 0, 0]
    assert Q.repeated_words([[b"x"] * 9, [b"x"] * 8]).tolist() == [9, 0]


def test_jensen_shannon_bounds():
    p, q = np.array([0.5, 0.5, 0.0]), np.array([0.0, 0.0, 1.0])
    assert Q.jensen_shannon(p, q) == 1 and Q.jensen_shannon(p, p) == 0
