"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np

from immolytics.llm import search_k2treap as S
from tests.llm.cases import case_frame

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=10):
    held = [(i, Counter(t)) for i, text in docs if (t := terms_of(text))]
    n_docs, n_all = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    of_item = {}
    for item, text in items:
        of_item.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, terms in of_item.items():
        found = []
        for doc, c in held:
            m = 100 - 90 + (90 * c.total() * n_docs) // n_all
            score = sum(weight[t] * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                found.append((-score, doc is None, doc))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, rank, doc, -s) for rank, (s, _, doc) in enumerate(found[:k], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def corpus(rng, n):
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(4000)]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 20, 60])))) for i in range(n)]
    docs += [(n + i, docs[i % 7][1]) for i in range(n // 3)]               # ties beyond the first ten
    rng.shuffle(docs)
    return docs, [(i, " ".join(rng.choices(words, k=rng.choice([1, 4, 30])))) for i in range(40)]


def test_equals_scoring_every_document(spark):
    docs, items = corpus(random.Random(1), 900)
    docs += [(None, docs[0][1]), (None, docs[0][1]), (3, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = plain(docs, items)
    assert rows_of(S.search(df, bench)) == want
    assert rows_of(S.search(df, bench, shard_bytes=3000, block_bytes=100)) == want
    assert rows_of(S.search(df, bench, k=3)) == plain(docs, items, 3)


def test_descent_scores_fewer_points_and_misses_none():
    rng = random.Random(5)
    docs, items = corpus(rng, 6000)
    docs = [(i, terms_of(t)) for i, t in docs]
    n_all = sum(len(t) for _, t in docs)
    shard = S.Shard(S.build_shard([i for i, _ in docs], [[w.encode() for w in t] for _, t in docs], len(docs), n_all))
    assert shard.top == 4
    fewer = 0
    for _, text in items:
        terms = [t.encode() for t in set(terms_of(text)) if t.encode() in shard.rows]
        rows = np.array([shard.rows[t] for t in terms], np.int64)
        weights = np.array([math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * shard.df[r] + 1))) for r in rows], np.int64)
        best, every = S.Best(10), S.Best(10)
        scored = S.search_shard(shard, rows, weights, best)
        points, w = shard.cells(rows, weights, 0)
        total = np.zeros(len(docs), np.int64)
        np.add.at(total, shard.range[0][points], w * shard.most[0][points])
        every.add(total[total > 0], shard.doc_ids[total > 0])
        assert best.scores.tolist() == every.scores.tolist() and best.ids.tolist() == every.ids.tolist()
        fewer += scored < len(points)
    assert fewer > len(items) / 2


def test_cells_hold_the_greatest_impact_below():
    rng = np.random.default_rng(3)
    texts = [[b"t%d" % w for w in rng.zipf(1.4, 40) % 50] for _ in range(600)]
    shard = S.Shard(S.build_shard(list(range(600)), texts, 600, 24000))
    for term, row in shard.rows.items():
        for level in range(1, shard.top + 1):
            cells, _ = shard.cells(np.array([row]), np.array([1]), level)
            if shard.df[row] <= S.FEW:
                assert not len(cells)
                continue
            points, _ = shard.cells(np.array([row]), np.array([1]), 0)
            at = shard.range[0][points] >> (3 * level)
            assert shard.range[level][cells].tolist() == sorted(set(at.tolist()))
            for c in cells:
                most = int(shard.most[0][points][at == shard.range[level][c]].max())
                assert most <= int(shard.most[level][c]) * S.STEP < most + S.STEP


def test_nulls_empty_repeated_long_and_clashing_columns(spark):
    df = case_frame(spark, score="s", item="i", item_id="x", rank="r")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    items = [(1, "the house"), (1, "river"), (2, None), (3, "..."), (None, "TEXT"), (None, "id"), (4, "unknownterm"), (5, "日本語の文章"),
             (6, "q" * 5000), (7, "İSTANBUL straße")]
    bench = spark.createDataFrame([(i, t, 0, 1) for i, t in items], "item_id int, text string, doc_id long, score long")
    assert rows_of(S.search(df, bench)) == plain(docs, items)
    assert rows_of(S.search(df.limit(0), bench)) == []
    assert rows_of(S.search(df, bench.limit(0))) == []
