import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from immolytics.operators import boosting, model as pm, tree_attribution

@pytest.fixture
def sales(spark):
    rng = np.random.default_rng(5)
    n = 3000
    pdf = pd.DataFrame({"a": rng.integers(0, 30, n).astype(float), "b": rng.integers(0, 12, n), "c d": rng.integers(0, 2, n) == 1,
                        "rare": (np.arange(n) % 500 == 0).astype(int), "same": 1})
    pdf["prix"] = 3 * np.sin(pdf.a) + pdf.b * pdf["c d"] + 40 * pdf.rare + rng.normal(0, 1, n)
    return spark.createDataFrame(pdf).repartition(3).cache()


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(pm, "ROWS_IN_PART", 400)
    for name, value in (("ROWS", 100), ("PART_ROWS", 1000), ("FRESH", 3), ("CELLS", 64)):
        monkeypatch.setattr(boosting, name, value)


def test_trees_from_blocks_equal_spark_ml(spark, sales, small_blocks, monkeypatch, tmp_path):
    features, params = ["a", "b", "c d", "rare", "same"], dict(maxIter=5, maxDepth=3, subsamplingRate=1.0)
    want = pm.price_pipeline(features, "prix", **params).fit(sales)
    monkeypatch.setattr(GBTRegressor, "_fit", lambda *a: pytest.fail("rows as objects"))
    got = pm.train_price_model(sales, features, **params)
    pairs = pm.score(got, sales).select("a", "b", "c d", "rare", "prix", "prediction").toPandas().merge(
        pm.score(want, sales).select("a", "b", "c d", "rare", "prix", F.col("prediction").alias("want")).toPandas(),
        on=["a", "b", "c d", "rare", "prix"])
    assert len(pairs) == 3000 and np.allclose(pairs.prediction, pairs.want, rtol=1e-9)
    assert np.allclose(got.stages[-1].featureImportances.toArray(), want.stages[-1].featureImportances.toArray())
    assert got.stages[-1].treeWeights == want.stages[-1].treeWeights and got.stages[-1].getMaxIter() == 5
    nodes = [sorted((t, f, round(cut, 9), round(v, 6)) for t, _, f, cut, _, _, v in tree_attribution.tree_nodes(spark, m)) for m in (got, want)]
    assert nodes[0] == nodes[1]
    pm.save_model(got, str(tmp_path / "m"))
    loaded = pm.score(pm.load_model(str(tmp_path / "m")), sales)
    assert loaded.agg(F.sum("prediction")).first()[0] == pytest.approx(pairs.prediction.sum())


def test_drawn_rows_and_folds(sales, small_blocks):
    model = pm.train_price_model(sales, ["a", "b", "c d", "rare"], maxIter=10)
    again = pm.train_price_model(sales, ["a", "b", "c d", "rare"], maxIter=10)
    error = [pm.score(m, sales).select(F.sqrt(F.avg((F.col("prix") - F.col("prediction")) ** 2))).first()[0] for m in (model, again)]
    assert error[0] < 2.5 and error[0] == pytest.approx(error[1])
    drawn = [t.toDebugString for t in model.stages[-1].trees]
    assert len(set(drawn)) == 10
    blocks = sales.withColumn("block", (F.xxhash64("a", "prix") % 3 + 3) % 3)
    scores = pm.fold_metrics(blocks, pm.gbt_fitter(["a", "b", "c d", "rare"], maxIter=3), 2, parallelism=2).collect()
    assert len(scores) == 4 and all(r.r2 > 0.1 for r in scores)


def test_bad_rows_and_other_parameters(sales, small_blocks):
    holes = sales.withColumn("b", F.when(F.col("rare") == 0, F.col("b").cast("double")))
    with pytest.raises(Exception, match="MUST NOT be NaN"):
        pm.train_price_model(holes, ["a", "b"], maxIter=2)
    with pytest.raises(Exception, match="Labels MUST NOT be Null"):
        pm.train_price_model(sales.withColumn("prix", F.when(F.col("rare") == 0, F.col("prix"))), ["a"], maxIter=2)
    assert not boosting.supports(sales, ["a"], {"lossType": "absolute"}) and not boosting.supports(sales, ["a"], {"maxDepth": 12})
    weighted = pm.train_price_model(sales.withColumn("w", F.col("b") + 1.0), ["a"], maxIter=2, weightCol="w")
    assert len(weighted.stages[-1].trees) == 2


def test_constant_rows_give_leaves(spark, small_blocks):
    flat = spark.range(1000).select(F.lit(1).alias("x"), (F.col("id") % 2 * 2.0).alias("prix"))
    got = pm.score(pm.train_price_model(flat, ["x"], maxIter=3, subsamplingRate=1.0), flat)
    assert [r[0] for r in got.select("prediction").distinct().collect()] == [pytest.approx(1.0)]


def test_quantiles_cover_all_rows(spark):
    rng = np.random.default_rng(1)
    x = rng.lognormal(0, 2, 50_000)
    df = spark.createDataFrame(pd.DataFrame({"x0": np.sort(x), "x1": np.arange(50_000) % 7 * 1.0})).repartition(7)
    n, tables = boosting.all_quantiles(df, 2)
    ranks = np.searchsorted(np.sort(x), tables[0]) / 50_000
    assert n == 50_000 and np.abs(ranks - np.linspace(0, 1, 1001)).max() < 0.005
    assert tables[0][0] == x.min() and tables[0][-1] == x.max()
    cuts = boosting.bin_cuts(tables, 32)
    assert len(cuts[0]) == 31 and list(cuts[1]) == [0.5, 1.5, 2.5, 3.5, 4.5, 5.5]


def test_folds_over_many_rows_score_in_batches(spark, sales, small_blocks, monkeypatch):
    features = ["a", "b", "c d", "rare"]
    model = pm.train_price_model(sales, features, maxIter=4)
    holes = sales.withColumn("a", F.when(F.col("b") == 3, float("nan")).when(F.col("b") != 5, F.col("a")))
    total = boosting.prediction(tree_attribution.tree_nodes(spark, model), features)
    pairs = pm.score(model, holes).withColumn("total", total).select("prediction", "total").toPandas()
    assert len(pairs) == 3000 and np.allclose(pairs.prediction, pairs.total, rtol=1e-12) and pairs.total.nunique() > 10
    blocks = sales.withColumn("block", F.pmod(F.xxhash64("a", "prix"), F.lit(3)).cast("int"))
    want = pm.fold_metrics(blocks, lambda train: lambda df: pm.score(pm.train_price_model(train, features, maxIter=2), df), 2).orderBy("fold", "role").toPandas()
    monkeypatch.setattr(pm, "score", lambda *a: pytest.fail("a row at a time"))
    got = pm.fold_metrics(blocks, pm.gbt_fitter(features, maxIter=2), 2).orderBy("fold", "role").toPandas()
    pd.testing.assert_frame_equal(got, want)


def test_nodes_keep_their_squares_and_many_rows_score_in_batches(sales, small_blocks, monkeypatch, tmp_path):
    features, params = ["a", "b", "c d", "rare"], dict(maxIter=4, maxDepth=3, subsamplingRate=1.0)
    want = pm.price_pipeline(features, "prix", **params).fit(sales)
    got = pm.train_price_model(sales, features, **params)
    saved = []
    for name, model in (("got", got), ("want", want)):
        model.stages[-1].save(str(tmp_path / name))
        nodes = sales.sparkSession.read.parquet(f"{tmp_path / name}/data").select("treeID", "nodeData.*").collect()
        saved.append(np.array(sorted((r.treeID, *r.impurityStats) for r in nodes)))
    assert saved[0].shape == saved[1].shape and np.allclose(saved[0], saved[1])
    scores = pm.score(want, sales).agg(F.sum("prediction")).first()[0]
    monkeypatch.setattr(PipelineModel, "transform", lambda *a: pytest.fail("a row at a time"))
    assert pm.score(got, sales).agg(F.sum("prediction")).first()[0] == pytest.approx(scores)


def test_one_sibling_is_counted_the_other_is_the_rest():
    rng = np.random.default_rng(2)
    sizes = [5, 3]
    code, step, cells = boosting.shared_codes(sizes)
    bins = np.stack([rng.integers(0, b, 500) for b in sizes])
    y = bins[0] * 2.0 + bins[1] ** 2 + rng.normal(0, .1, 500)
    codes = np.zeros((len(cells), 500), "i2")
    for f in range(2):
        codes[code[f]] += (bins[f] * step[f]).astype("i2")
    asked = []

    def count(levels, chosen):
        asked.append((len(levels), len(chosen)))
        found = next(boosting.counter(levels, chosen, code, step, sizes, cells, 8)(iter([(0, codes, y, None, None)])))
        return found[:-8].reshape(2, len(chosen), sum(sizes))

    levels, nodes = boosting.grow(count, boosting.Params(1, 3, 1.0, 1.0, 2, 0.0, 1), code, step, sizes)
    assert asked == [(0, 1), (1, 1), (2, 2)]
    place = boosting.places(levels, cells)(codes)
    leaves = {i: stats for (level, i), (stats, split) in nodes.items() if level == 3}
    assert leaves and all(stats[0] == (place == i).sum() and stats[1] == pytest.approx(y[place == i].sum()) for i, stats in leaves.items())


def test_cross_validation_fits_every_tree_of_the_reference(spark, monkeypatch):
    from immolytics.plans import queries
    from immolytics.settings import GBT_PARAMS
    pdf = pd.DataFrame({c: np.arange(60) % (3 + i) + 1.0 for i, c in enumerate(queries.BASE_FEATURES)})
    pdf["annee_transaction"], pdf["mois_transaction"] = 2018 + np.arange(60) // 24, np.arange(60) % 12 + 1
    pdf["id_transaction"], pdf["prix"] = [f"r{i:02d}" for i in range(60)], np.arange(60) + 1.0
    monkeypatch.setattr(queries, "prepared", lambda *a: spark.createDataFrame(pdf))
    monkeypatch.setattr(pm, "gbt_fitter", lambda features, label, **changed: asked.append(changed) or pm.mean_fitter(label))
    asked = []
    assert queries.QUERIES["cv_gbt"](spark, "").count() == 5
    assert [{**GBT_PARAMS, **changed} for changed in asked] == [GBT_PARAMS] and GBT_PARAMS["maxIter"] == 150
