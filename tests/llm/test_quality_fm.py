"""The factorisation machine: its identity, held-out accuracy and unusual rows."""

import numpy as np

from immolytics.llm.quality_fm import FactorisationMachine, SLOTS, fit_machine, fit_quality, make_features, score_quality
from immolytics.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm.cases import CASES, case_frame


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    m = FactorisationMachine(0.3, rng.standard_normal(SLOTS), rng.standard_normal((SLOTS, 8)).astype(np.float32))
    rows = [(rng.choice(SLOTS, n, replace=False), rng.random(n)) for n in (0, 1, 5, 40)]
    got = m.logits(np.concatenate([r[0] for r in rows]).astype(int), np.concatenate([r[1] for r in rows]),
                   np.array([len(r[0]) for r in rows]))
    for (slots, values), logit in zip(rows, got):
        want = m.bias + sum(m.linear[s] * v for s, v in zip(slots, values))
        want += sum(float(m.factors[slots[i]] @ m.factors[slots[j]]) * values[i] * values[j]
                    for i in range(len(slots)) for j in range(i))
        assert abs(want - logit) < 1e-3


def test_learns_an_interaction():
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for _ in range(4000):
        on = rng.random(2) < 0.5
        rows.append((np.array([0, 1])[on].astype(np.int64), np.ones(on.sum())))
        labels.append(float(on[0] == on[1]))               # not linear
    m = fit_machine(rows, np.array(labels))
    p = m.logits(np.array([0, 1, 0, 1]), np.ones(4), np.array([0, 1, 1, 2]))
    assert p[0] > 0 and p[3] > 0 and p[1] < 0 and p[2] < 0


def test_held_out_accuracy(spark):
    rows = QUERIES["op1_quality_fm"](spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in held) / len(held) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_unusual_rows_and_no_labels(spark):
    df = case_frame(spark, score="clash", predicted="clash", held_out="clash")
    labels = spark.createDataFrame([(4, 1), (5, None), (None, 0)], "doc_id long, quality int")
    for known in (labels, labels.limit(0)):
        m = fit_quality(df, known)
        rows = score_quality(df, m, keep=("doc_id", "score", "held_out")).collect()
        assert len(rows) == len(CASES) and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 4}) == 1
    assert {r.score for r in rows} == {0.5}
    assert score_quality(df.limit(0), m).collect() == []


def test_features_cover_the_whole_text():
    features = make_features()
    a, b = features([b"word " * 5000 + b"end"]), features([b"word " * 5000 + b"fin"])
    assert sorted(a[0].tolist()) != sorted(b[0].tolist())
