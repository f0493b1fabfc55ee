"""Winnowing against a brute-force window search."""

import hashlib
import random
import re

import numpy as np

from immolytics.llm.decontaminate_winnow import decontaminate, gram_hashes, hits, winnowed
from immolytics.llm.queries import QUERIES
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, window=10):
    windows = {}
    for item, text in items:
        words = words_of(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if words else 0):
            windows.setdefault(tuple(words[i:i + n]), set()).update([] if item is None else [str(item)])
    lengths = sorted({len(w) for w in windows})
    out = []
    for doc, text in docs:
        words, hit, found = words_of(text), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i:i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[w]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()),
                  key=str)


def read(spark, name, key):
    return [(r[key], r.text) for r in spark.read.parquet(f"{SF_SMALL}/{name}.parquet").collect()]


def test_query_equals_brute_force(spark):
    docs, items = read(spark, "documents", "doc_id"), read(spark, "benchmark", "item_id")
    want = plain(docs, items)
    assert any(r[-1] for r in want)
    assert rows_of(QUERIES["op10_winnowing"](spark, SF_SMALL)) == want


def test_random_small_alphabet(spark):
    rng = random.Random(3)
    def text(n):
        return " ".join(rng.choice("a b c D é".split()) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 6, 9, 10, 11, 14, 30]))) for i in range(4, 40)]
    docs = [(i, text(rng.choice([0, 2, 9, 10, 25, 80]))) for i in range(60)]
    docs += [(100 + i, f"x{i} " + items[i][1] + f" y{i}") for i in range(len(items))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(decontaminate(df, bench)) == plain(docs, items)
    long_items = [x for x in items if len(words_of(x[1])) >= 9]
    bench = spark.createDataFrame(long_items, "item_id long, text string")
    assert rows_of(decontaminate(df, bench)) == plain(docs, long_items)


def test_nulls_empty_repeated_and_clashing_columns(spark):
    passage = "one two three four five six seven eight nine ten"
    docs = [(1, None), (2, ""), (3, passage), (3, passage), (3, "other"), (None, "So, " + passage.upper() + "!"),
            (4, "word " * 20000 + passage), (5, passage[:-3])]
    items = [(1, passage), (1, passage), (12, passage + " eleven"), (2, None), (3, "..."), (None, "other"), (None, passage)]
    df = spark.createDataFrame([(d, t, "h", 1) for d, t in docs], "doc_id long, text string, item_id string, n_hit int")
    bench = spark.createDataFrame([(d, t, 0) for d, t in items], "item_id long, text string, doc_id long")
    want = plain(docs, items)
    assert (3, 1, 1, 0, hashlib.sha256(b"").hexdigest(), True) in want         # a passage of a null id alone
    assert rows_of(decontaminate(df, bench)) == want
    assert rows_of(decontaminate(df, bench.limit(0))) == plain(docs, [])
    assert rows_of(decontaminate(df.limit(0), bench)) == []


def test_winnowing_keeps_a_fingerprint_of_every_shared_span():
    rng = np.random.default_rng(5)
    shared = rng.integers(0, 9, 10).astype(np.uint64)
    for _ in range(50):
        kept = []
        for _ in range(2):
            words = np.concatenate([rng.integers(0, 9, rng.integers(0, 30)).astype(np.uint64), shared,
                                    rng.integers(0, 9, rng.integers(0, 30)).astype(np.uint64)])
            hashes = gram_hashes(words, 6, 10)
            kept.append({int(hashes[i]) for i in winnowed(hashes, 5)})
        inside = {int(h) for h in gram_hashes(shared, 6, 10)}
        assert kept[0] & kept[1] & inside


def test_a_phrase_that_all_share_costs_no_pairs(spark):
    phrase = "which of the following statements is true"
    rng = random.Random(6)
    def text(i):
        return " ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(12)) + f" {phrase} " + " ".join(f"v{rng.randrange(10 ** 9)}" for _ in range(12))
    items = [(i, text(i)) for i in range(1500)]
    docs = [(i, text(i)) for i in range(1500)] + [(2000, "so " + items[7][1]), (2001, items[8][1][20:])]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows, spans, windows = hits(df, bench)
    assert spans.count() < 100
    assert [r.doc_id for r in decontaminate(df, bench).where("contaminated").orderBy("doc_id").collect()] == [2000, 2001]
