"""The pipeline, stage by stage against brute force."""

import corpus_pipeline as C
from immolytics.llm import lang_unigram as L, secret_guess as S
from immolytics.session import materialize
from immolytics.sources.tables import table
from tests.conftest import SF_SMALL
from tests.llm.cases import case_frame
from tests.llm.test_decontaminate_winnow import plain as plain_hits
from tests.llm.test_pack_residual import PATH, check
from tests.llm.test_simhash_vptree import plain_components, plain_fingerprint
from tests.llm.test_secret_guess import plain as plain_secrets


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def one_of_each(rows):
    """The row of smallest doc_id (null last) of each brute-force component."""
    points = [plain_fingerprint(r[1]) for r in rows]
    group = plain_components(list(range(len(rows))), points, 3)
    best = {}
    for r, g in zip(rows, group):
        if g not in best or (r[0] is None, r[0] or 0) < (best[g][0] is None, best[g][0] or 0):
            best[g] = r
    return sorted(best.values(), key=str)


def test_every_stage_against_brute_force(spark):
    docs, items = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    told = materialize(C.language(spark, docs, SF_SMALL), "t")
    assert told.schema == docs.schema
    scorer = L.Scorer(L.fit_languages(docs))
    rows = rows_of(docs)
    names, scores = scorer([r[1].encode() for r in rows])
    assert rows_of(told) == [r for r, n, s in zip(rows, names, scores) if n != "und" and s >= 0.5]

    single = materialize(C.near_duplicates(spark, told, SF_SMALL), "t")
    assert single.schema == docs.schema and rows_of(single) == one_of_each(rows_of(told))

    clean = materialize(C.decontamination(spark, single, SF_SMALL), "t")
    hits = {d: c for d, *_, c in plain_hits([(r[0], r[1]) for r in rows_of(single)], [tuple(r) for r in items.collect()])}
    assert rows_of(clean) == [r for r in rows_of(single) if not hits[r[0]]] and any(hits.values())

    masked = materialize(C.secrets(spark, clean, SF_SMALL), "t")
    after = {r[0]: r for r in rows_of(masked)}
    for r in rows_of(clean):
        new = after[r[0]]
        assert (new[1] == r[1]) == (not S.secret_spans(r[1].encode())[1]) and new[4] == len(new[1])
        assert new[2:4] == r[2:4] and not plain_secrets(new[1])

    packed = C.packing(spark, masked, SF_SMALL).collect()
    check(packed, [(r[0], r[1]) for r in rows_of(masked)], 2048)
    whole = C.run(spark, SF_SMALL).collect()
    strip = lambda rs: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rs)
    assert strip(whole) == strip(packed)


def test_unusual_rows_pass_every_stage(spark):
    docs = case_frame(spark, score="c", lang_pred="c", group="c", contaminated="c", point="c", length="c")
    told = C.language(spark, docs, SF_SMALL)
    assert told.schema == docs.schema
    assert {r.doc_id for r in told.collect()} == {4, 5, 6, 7, 8, 10, None, 12}
    single = C.near_duplicates(spark, docs, SF_SMALL)
    want = one_of_each([tuple(r) for r in docs.collect()])
    assert single.schema == docs.schema and sorted(str(r[0]) for r in want) == sorted(str(r.doc_id) for r in single.collect())
    clean = C.decontamination(spark, docs, SF_SMALL)
    assert clean.schema == docs.schema and clean.count() == docs.count()
    assert C.secrets(spark, docs, SF_SMALL).columns == docs.columns
    check(C.packing(spark, docs, SF_SMALL).collect(), [(r.doc_id, r.text) for r in docs.collect()], 2048)
    for _, stage in C.STAGES:
        assert stage(spark, docs.limit(0), SF_SMALL).collect() == []


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in C.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "packing"]
    assert C.ORACLE_SQL is None and PATH
