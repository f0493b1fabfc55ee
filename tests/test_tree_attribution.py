"""Exact attributions against enumerated Shapley values over the whole background."""

from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from immolytics.operators import tree_attribution as T

FEATURES = ["a", "b", "c", "d"]


def enumerated(f, xs, zs):
    """Interventional Shapley values of ``f`` (rows of values to predictions), every coalition, every background row."""
    p, out = xs.shape[1], []
    for x in xs:
        value = {}
        for size in range(p + 1):
            for s in combinations(range(p), size):
                mixed = zs.copy()
                mixed[:, list(s)] = x[list(s)]
                value[s] = f(mixed).mean()
        out.append([sum(factorial(len(s)) * factorial(p - len(s) - 1) / factorial(p) * (value[tuple(sorted((*s, j)))] - value[s])
                        for size in range(p) for s in combinations([i for i in range(p) if i != j], size)) for j in range(p)])
    return np.array(out)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.integers(0, 12, size=(150, 4)).astype(float), columns=FEATURES)
    pdf["d"] = (pdf.d > 6).astype(float)
    pdf["y"] = pdf.a * pdf.b + 5 * (pdf.c > 4) * pdf.d - pdf.b + rng.normal(0, 1, 150)
    pdf["id"] = [f"r{i}" for i in range(150)]
    return pdf, spark.createDataFrame(pdf).repartition(3)


def as_table(phi, ids):
    got = {(r["id"], r["feature"]): r["phi"] for r in phi.collect()}
    return np.array([[got[i, f] for f in FEATURES] for i in ids])


@pytest.mark.parametrize("trees", [lambda: DecisionTreeRegressor(maxDepth=7, maxBins=64),
                                   lambda: RandomForestRegressor(numTrees=4, maxDepth=3, seed=1),
                                   lambda: GBTRegressor(maxIter=4, maxDepth=3, stepSize=0.3)])
def test_equals_enumerated_values_over_the_whole_background(spark, data, trees):
    pdf, df = data
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)
    model = trees().setLabelCol("y").fit(assembled)
    nodes = T.tree_nodes(spark, model)
    few, background = df.where("id in ('r1', 'r7', 'r70', 'r149')"), df.where("id <> 'r3'")
    by_tree = {}
    for n in nodes:
        by_tree.setdefault(n[0], {})[n[1]] = n

    def f(rows):
        total = np.zeros(len(rows))
        for tree in by_tree.values():
            for i, row in enumerate(rows):
                node = tree[0]
                while node[2] >= 0:
                    node = tree[node[4] if row[node[2]] <= node[3] else node[5]]
                total[i] += node[6]
        return total

    predicted = {r["id"]: r["prediction"] for r in model.transform(assembled).collect()}
    assert f(pdf[FEATURES].to_numpy()) == pytest.approx([predicted[i] for i in pdf.id], rel=1e-12)
    ids = ["r1", "r7", "r70", "r149"]
    xs, zs = pdf.set_index("id").loc[ids, FEATURES].to_numpy(), pdf[pdf.id != "r3"][FEATURES].to_numpy()
    got = as_table(T.tree_attribution(few, background, nodes, FEATURES, "id"), ids)
    assert got == pytest.approx(enumerated(f, xs, zs), abs=1e-9)
    start = spark.range(1).select(T.expected_value(background, nodes, FEATURES).alias("e")).first()["e"]
    assert start == pytest.approx(f(zs).mean(), rel=1e-12)


def test_trees_of_more_conditions_than_a_word(spark, data, monkeypatch):
    _, df = data
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)
    nodes = T.tree_nodes(spark, DecisionTreeRegressor(maxDepth=6, maxBins=64, labelCol="y").fit(assembled))
    whole = as_table(T.tree_attribution(df, df, nodes, FEATURES, "id"), ["r1", "r2"])
    monkeypatch.setattr(T, "WORD", 5)
    assert as_table(T.tree_attribution(df, df, nodes, FEATURES, "id"), ["r1", "r2"]) == pytest.approx(whole, abs=1e-9)


def test_missing_values_and_single_leaves(spark):
    nodes = [(0, 0, 0, 1.5, 1, 2, 0.0), (0, 1, -1, 0.0, -1, -1, 4.0), (0, 2, -1, 0.0, -1, -1, 10.0), (1, 0, -1, 0.0, -1, -1, 3.0)]
    rows = spark.createDataFrame([("x", 1.0, 0.0), ("y", None, 0.0), ("z", float("nan"), 1.0)], "id string, a double, b double")
    got = {(r["id"], r["feature"]): r["phi"] for r in T.tree_attribution(rows, rows, nodes, ["a", "b"], "id").collect()}
    assert got == pytest.approx({("x", "a"): -4.0, ("y", "a"): 2.0, ("z", "a"): 2.0, ("x", "b"): 0.0, ("y", "b"): 0.0, ("z", "b"): 0.0})


def test_no_plan_draws_or_explodes_the_background(spark, data):
    _, df = data
    nodes = [(0, 0, 0, 3.0, 1, 2, 0.0), (0, 1, -1, 0.0, -1, -1, 4.0), (0, 2, -1, 0.0, -1, -1, 10.0)]
    plan = T.tree_attribution(df, df, nodes, FEATURES, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "Join Cross" not in plan and "Sample" not in plan


def test_products_equal_enumerated_values(spark, data):
    pdf, df = data
    terms = [(2.0, ("a", "b", "c")), (-1.0, ("a",)), (0.5, ("c", "d"))]
    ids = ["r0", "r5"]
    xs, zs = pdf.set_index("id").loc[ids, FEATURES].to_numpy(), pdf[FEATURES].to_numpy()
    want = enumerated(lambda m: 2 * m[:, 0] * m[:, 1] * m[:, 2] - m[:, 0] + 0.5 * m[:, 2] * m[:, 3], xs, zs)
    phi = T.product_attribution(df.where(F.col("id").isin(ids)), df, terms, FEATURES, "id")
    assert as_table(phi, ids) == pytest.approx(want, abs=1e-9)


def test_tables_and_joins_agree_on_repeated_and_missing_keys(spark, data, monkeypatch):
    pdf, _ = data
    odd = pdf.copy()
    odd.loc[3:5, "id"], odd.loc[7:9, "id"], odd.loc[10:12, "a"] = "r0", None, None
    df = spark.createDataFrame(odd)
    nodes = T.tree_nodes(spark, GBTRegressor(maxIter=3, maxDepth=4, labelCol="y").fit(
        VectorAssembler(inputCols=FEATURES, outputCol="features").transform(data[1])))

    def found():
        phi = T.tree_attribution(df, df, nodes, FEATURES, "id")
        start = spark.range(1).select(T.expected_value(df, nodes, FEATURES)).first()[0]
        return phi, {(r["id"], r["feature"]): r["phi"] for r in phi.collect()}, start

    phi, rows, start = found()
    assert "Join" not in phi._jdf.queryExecution().optimizedPlan().toString()      # rows look up their patterns in place
    monkeypatch.setattr(T, "MOST_CELLS", 0)
    _, want, want_start = found()
    assert len(rows) == 145 * 4 and rows == pytest.approx(want, abs=1e-9) and start == pytest.approx(want_start)


def test_global_importance_is_over_all_rows_and_the_whole_background(spark, data):
    from immolytics.operators.attribution import global_importance
    pdf, df = data
    xs = pdf[FEATURES].to_numpy()
    want = np.abs(enumerated(lambda m: m[:, 0] * m[:, 1], xs, xs)).mean(axis=0)
    phi = T.product_attribution(df, df, [(1.0, ("a", "b"))], FEATURES, "id")
    got = {r["feature"]: r["mean_abs_phi"] for r in global_importance(phi).collect()}
    assert [got[f] for f in FEATURES] == pytest.approx(want, abs=1e-9)
