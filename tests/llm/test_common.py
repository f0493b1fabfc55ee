"""Shared helpers: bounded slices, memo, sums of segments, folds and samples."""

import zlib

import numpy as np
import pyarrow as pa

from immolytics.llm import common as C


def test_slices_are_bounded_and_whole(monkeypatch):
    monkeypatch.setattr(C, "ROWS_AT_ONCE", 3)
    monkeypatch.setattr(C, "BYTES_AT_ONCE", 10)
    texts = [b"a" * n for n in (1, 2, 3, 4, 50, 0, 5, 5, 6)] + [None, None, None, None, b"z"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.binary())], names=["i", "t"])
    parts = [p.column(1).to_pylist() for p in C.slices(batch, 1)]
    assert [x for p in parts for x in p] == texts
    assert all(len(p) <= 3 and (len(p) == 1 or sum(len(x or b"") for x in p) <= 10) for p in parts)
    assert list(C.slices(batch.slice(0, 0), 1)) == []


def test_memo_is_bounded():
    memo = C.Memo(lambda k: k * 2, limit=3)
    assert [memo[i] for i in range(10)] == [2 * i for i in range(10)] and len(memo) <= 3


def test_segment_sums_with_empty_segments():
    lengths = np.array([0, 2, 0, 3, 0])
    got = C.segment_sums(np.arange(5.0), np.cumsum(lengths) - lengths, lengths)
    assert got.tolist() == [0, 1, 0, 9, 0]
    assert C.segment_sums(np.zeros((0, 2)), np.zeros(1, int), np.zeros(1, int)).tolist() == [[0, 0]]


def test_folds_follow_crc32(spark):
    rows = spark.range(50).selectExpr("CAST(id * 37 AS BIGINT) AS doc_id").select("doc_id", C.fold_of("doc_id", 5).alias("f"))
    assert all(r.f == zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows.collect())
    null = spark.sql("SELECT CAST(NULL AS BIGINT) AS doc_id").select(C.fold_of("doc_id", 5).alias("f")).first()
    assert null.f == 0


def test_labelled_sample_is_bounded_and_leaves_out_the_held_out_fold(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "'t' AS text")
    labels = spark.range(400).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    rows = C.labelled_sample(docs, labels, "quality", 60, 5).collect()
    assert len(rows) == 60 and all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows)
    assert len(C.labelled_sample(docs, labels, "quality", 10_000, 5).collect()) < 400
