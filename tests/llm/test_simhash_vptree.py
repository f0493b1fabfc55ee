"""SimHash fingerprints and components against brute force."""

import re

import numpy as np
import pytest
import xxhash

from immolytics.llm.queries import QUERIES
from immolytics.llm.simhash_vptree import VantageTree, components, links, near_duplicates
from tests.conftest import SF_SMALL


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, points, reach):
    parent = list(range(len(ids)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (points[i] ^ points[j]).bit_count() <= reach:
                parent[top(i)] = top(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return [least.get(top(i)) for i in range(len(ids))]


def compare(rows, texts, reach=3):
    points = [plain_fingerprint(t) for _, t in texts]
    want = sorted(((d, f"{p:016x}", c) for (d, _), p, c in
                   zip(texts, points, plain_components([d for d, _ in texts], points, reach))), key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in rows), key=str) == want


def test_query_equals_brute_force(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    compare(QUERIES["op5_simhash_vptree"](spark, SF_SMALL).collect(), texts)


def test_small_leaves_lose_no_link(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    compare(near_duplicates(df, max_bits=12, leaf=8).collect(), texts, reach=12)


def test_nulls_empty_short_and_repeated(spark):
    texts = [(5, None), (6, ""), (2, " \n"), (7, "One"), (7, "one"), (8, "one two"), (None, "ONE two"),
             (None, "only nameless"), (9, "a b c d " * 4000), (10, " nbsp is a word")]
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in texts],
                               "doc_id long, text string, fingerprint string, component_id string")
    compare(near_duplicates(df).collect(), texts)
    assert near_duplicates(df.limit(0)).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_tree_brings_every_close_pair_together(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (300, 3), dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    points = np.unique(np.concatenate([base, base ^ flips]))
    tree = VantageTree(points, 32)
    assert tree.n_leaves > 8
    index, leaf, home = tree.route(points, 3)
    assert sorted(index[home]) == list(range(len(points)))        # one home each
    at = {}
    for i, l, h in zip(index.tolist(), leaf.tolist(), home.tolist()):
        at.setdefault(l, ([], []))[0 if h else 1].append(i)
    met = {frozenset((i, j)) for homes, guests in at.values() for i in homes for j in homes + guests}
    for i in range(len(points)):
        for j in range(i):
            if int(points[i] ^ points[j]).bit_count() <= 3:
                assert frozenset((i, j)) in met


def test_oversized_leaves_are_compared_in_blocks(spark):
    points = [(1 << 3 * i, ) for i in range(20)] + [((1 << 3 * i) | 1 << 61, ) for i in range(20)]
    df = spark.createDataFrame(points, "point long")
    for visitors in (1 << 18, 5):
        rows = components(links(df, 1, leaf=2, visitors=visitors)).collect()
        assert len({r.root for r in rows}) == 20 and len(rows) == 20
    rows = components(links(df, 1, leaf=10_000, visitors=3)).collect()       # one leaf, many parts
    assert len({r.root for r in rows}) == 20 and len(rows) == 20


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(i, i + 1) for i in range(100, 130)] + [(7, 7)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    found = {r.node: r.root for r in rows}
    assert found == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 131)}}
