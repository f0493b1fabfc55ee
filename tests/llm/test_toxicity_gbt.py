"""Toxicity: features, held-out accuracy and unusual rows."""

from immolytics.llm.queries import QUERIES
from immolytics.llm.toxicity_gbt import Lexicon, fit_toxicity, make_features, score_toxicity
from tests.conftest import SF
from tests.llm.cases import CASES, case_frame


def test_features():
    features = make_features(Lexicon({"blarg": 2.0}))
    calm, rude, masked, learned, empty = features(
        [b"the river runs past the house", b"you are an IDIOT!! you idiot", b"what an 1d10t and st*pid", b"blarg blarg", None])
    assert not any(calm[:9]) and calm[13] == 0
    assert rude[1] == 2000 / 6 and rude[7] > 0 and rude[9] > 0 and rude[10] > 0 and rude[12] > 0
    assert masked[13] > 0 and masked[1] > 0
    assert learned[4] == 1000 and learned[5] == 2.0
    assert not any(empty)


def test_held_out_accuracy(spark):
    folder = SF.replace("sf0.01", "sf0.1")                                   # the smaller table holds out six toxic rows
    rows = QUERIES["op4_toxicity_gbt"](spark, folder).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    right, majority = sum(p == y for p, y in held), max(sum(y == k for _, y in held) for k in (0, 1))
    assert right / len(held) > 0.9 and right > majority                     # a constant gets the majority right
    toxic, flagged = [p for p, y in held if y == 1], [y for p, y in held if p == 1]
    print(f"right {right} of {len(held)}, majority {majority}, recall {sum(toxic)}/{len(toxic)}, precision {sum(flagged)}/{len(flagged)}")
    assert toxic and sum(toxic) / len(toxic) >= 0.7 and sum(flagged) / len(flagged) >= 0.7
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_unusual_rows_and_missing_labels(spark):
    df = case_frame(spark, score="clash", predicted="clash", features="clash")
    rude = spark.createDataFrame([(100 + i, "you stupid idiot " * (1 + i % 3) if i % 2 else "a calm text of words", "en", "s", 1,
                                   "c", "c", "c") for i in range(80)], df.schema)
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(80)] + [(4, None), (None, 1)], "doc_id long, toxic int")
    both = df.union(rude)
    rows = score_toxicity(both, fit_toxicity(both, labels), keep=("doc_id", "features", "score")).collect()
    assert len(rows) == len(CASES) + 80 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == r.doc_id % 2 for r in rows if (r.doc_id or 0) >= 100)
    none = fit_toxicity(both, labels.limit(0))
    assert {r.score for r in score_toxicity(df, none).collect()} == {0.0}
    assert score_toxicity(df.limit(0), none).collect() == []
