"""Packing against whole-text encoding, gapless sequences and a bound on the bins used."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from immolytics.llm.pack_residual import best_fit, pack_documents
from immolytics.llm.queries import QUERIES
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, texts, capacity):
    """Every id of every text once, in order; sequences gapless and within the capacity."""
    tok = Tokenizer.from_file(PATH)
    want, got = [], []
    for doc, text in texts:
        ids = np.asarray(tok.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            cut = ids[start:start + capacity]
            want.append((doc, piece, start, len(cut), zlib.crc32(cut.tobytes())))
    by_sequence = {}
    for r in rows:
        got.append((r.doc_id, r.piece, r.start, r.length, r.ids_crc32))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    def order(t):
        return tuple((x is None, x or 0) for x in t)
    assert sorted(got, key=order) == sorted(want, key=order)
    for members in by_sequence.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return by_sequence


def test_query_packs_the_whole_table(spark):
    rows = QUERIES["op9_best_fit_packing"](spark, SF_SMALL).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    sequences = check(rows, texts, 2048)
    total = sum(r.length for r in rows)
    assert len(sequences) <= 1.05 * -(-total // 2048) + 1


def test_nulls_empty_long_repeated_and_unusual_texts(spark):
    texts = [(1, None), (2, ""), (3, "word " * 3000), (4, "same"), (4, "same"), (None, "no id"),
             (5, "a<|endoftext|>b  x y İ é n'́t 's 12 \U0001f600"), (6, "x" * 5000), (7, " \n\t ")]
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in texts],
                               "doc_id long, text string, sequence_id string, piece int").repartition(3)
    check(pack_documents(df, PATH, capacity=64, block=8).collect(), texts, 64)


def test_merge_rounds_join_underfull_bins(spark):
    texts = [(i, "one two three") for i in range(120)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(40)
    sequences = check(pack_documents(df, PATH, capacity=64, block=7).collect(), texts, 64)
    assert len(sequences) <= 10             # 16 texts of 4 tokens fill a sequence: 8 at best


def test_merging_goes_on_until_no_two_sequences_fit_into_one(spark):
    def words(i, n):                                       # n tokens with the end
        return i, "one " * (n - 1)
    def in_tasks(*parts):                                  # of as many rows each
        rdd = spark.sparkContext.parallelize([x for part in parts for x in part], len(parts))
        return spark.createDataFrame(rdd, "doc_id long, text string")
    # The only pair that fits lies in two tasks among hundreds of bins that fit nowhere.
    left, right = [words(i, 50) for i in range(150)] + [words(150, 44)], [words(i, 50) for i in range(200, 350)] + [words(350, 20)]
    rows = pack_documents(in_tasks(left, right), PATH, capacity=64, block=20).collect()
    assert len(check(rows, left + right, 64)) == 301
    # One free token takes an empty text.
    left, right = [words(1, 63)], [(2, "")]
    rows = pack_documents(in_tasks(left, right), PATH, capacity=64).collect()
    assert len(check(rows, left + right, 64)) == 1
    # Many bins in many groups: afterwards no two fit into one.
    parts = [[words(100 * k + i, 23 + (7 * k + 13 * i) % 29) for i in range(7)] for k in range(12)]
    rows = pack_documents(in_tasks(*parts), PATH, capacity=64, block=8).collect()
    fills = sorted(sum(n for _, n in m) for m in check(rows, [x for part in parts for x in part], 64).values())
    assert fills[0] + fills[1] > 64


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(df, PATH).collect() == []


def test_best_fit_takes_the_tightest_bin():
    place, offset, fill = best_fit([6, 3, 5, 4, 2], 10)
    assert sorted(fill) == [10, 10] and all(o + s <= 10 for o, s in zip(offset, [6, 3, 5, 4, 2]))
    assert place[0] == place[3]
