import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from immolytics.functions.scalar import oui_non, round_half_even
from immolytics.functions.text import allowed_region, normalize_py, normalize_text
from immolytics.operators import attribution, model as pm

SAMPLES = ["  Île-de-France ", "Provence-Alpes-Côte d'Azur", "ÉCOLE \tMaternelle\n", "Straße  Ñandú", "x y"]
FOREIGN = ["がぎ 東京都", "한글 각 갂 힣", "x\u3099 y\u0323", "\U0001d15e \U0001e944 \U000110ab", "\u0344 \u0f73 x", "ﬁ Ǆ ẞ Å"]


def test_normalize_text_matches_python(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "s string")
    got = [r[0] for r in df.select(normalize_text("s")).collect()]
    assert got == [normalize_py(s) for s in SAMPLES]
    ok = df.select(allowed_region("s")).collect()
    assert [r[0] for r in ok] == [True, True, False, False, False]


def test_normalize_text_of_all_unicode(spark):
    import sys
    import unicodedata
    chars = [chr(c) for c in range(0x20, sys.maxunicode + 1) if unicodedata.category(chr(c)) not in ("Cs", "Cn", "Co")]
    texts = FOREIGN + ["a" + "b".join(chars[i:i + 256]) + " c" for i in range(0, len(chars), 256)]
    df = spark.createDataFrame([(s,) for s in texts], "s string").repartition(4)
    assert {r[0]: r[1] for r in df.select("s", normalize_text("s")).collect()} == {s: normalize_py(s) for s in texts}


def test_round_half_even_like_numpy(spark):
    vals = [2.675, 5.025, 0.125, 1.005, 1229.764459]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(round_half_even("v", 2)).collect()]
    assert got == [float(np.round(v, 2)) for v in vals]
    assert [r[0] for r in spark.createDataFrame([("Oui",), ("non",), ("?",)], "s string")
            .select(oui_non("s")).collect()] == [1, 0, None]


def test_shapley_efficiency_gbt(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame(rng.uniform(0, 5, size=(200, 3)), columns=["a", "b", "c"])
    pdf["prix"] = pdf.a * 3 + pdf.b * pdf.c
    pdf["id"] = [f"r{i}" for i in range(200)]
    df = spark.createDataFrame(pdf)
    model = pm.train_price_model(df, ["a", "b", "c"], maxIter=5, maxDepth=3)
    scorer = lambda d: pm.score(model, d)
    rows, bg = df.limit(5), df.where("id = 'r7'")              # one background row: every draw is it
    fx = {r["id"]: r["prediction"] for r in scorer(rows).collect()}
    base = scorer(bg).first()["prediction"]
    for n_pairs in (2, None):
        phi = attribution.shapley_attribution(rows, bg, ["a", "b", "c"], "id", scorer, n_pairs=n_pairs)
        tot = {r["id"]: r["s"] for r in phi.groupBy("id").agg(F.sum("phi").alias("s")).collect()}
        for k, s in tot.items():
            assert s == pytest.approx(fx[k] - base, abs=1e-6)
    top = attribution.top_attributions(phi, "id", 2)
    assert top.groupBy("id").count().agg(F.max("count")).first()[0] == 2


def test_all_orders_equal_enumerated_shapley_of_trees(spark):
    from itertools import permutations
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.uniform(0, 5, size=(150, 3)), columns=["a", "b", "c"])
    pdf["prix"] = pdf.a * pdf.b * pdf.c
    pdf["id"] = [f"r{i}" for i in range(150)]
    df = spark.createDataFrame(pdf)
    model = pm.train_price_model(df, ["a", "b", "c"], maxIter=4, maxDepth=4)
    rows, bg = df.where("id IN ('r3', 'r90')"), df.where("id = 'r50'")
    got = {(r["id"], r["feature"]): r["phi"] for r in attribution.shapley_attribution(
        rows, bg, ["a", "b", "c"], "id", lambda d: pm.score(model, d), n_pairs=None, n_draws=2).collect()}
    z = pdf[pdf.id == "r50"].iloc[0]
    for key in ("r3", "r90"):
        x = pdf[pdf.id == key].iloc[0]
        subsets = [(m, *[(x if m >> i & 1 else z)[f] for i, f in enumerate("abc")]) for m in range(8)]
        f = {r["m"]: r["prediction"] for r in pm.score(model, spark.createDataFrame(
            [(m, *map(float, v)) for m, *v in subsets], "m int, a double, b double, c double")).collect()}
        for i, name in enumerate("abc"):
            gains = []
            for order in permutations(range(3)):
                before = sum(1 << j for j in order[:order.index(i)])
                gains.append(f[before | 1 << i] - f[before])
            assert got[key, name] == pytest.approx(np.mean(gains), abs=1e-9)


def test_draws_cover_the_whole_background(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"), F.col("id").cast("double").alias("x"))
    numbered = attribution.numbered(df, "k", "s")
    got = numbered.agg(F.min("_index"), F.max("_index"), F.count_distinct("_index"), F.max("_rows")).first()
    assert tuple(got) == (0, 499, 500, 500)
    phi = attribution.shapley_attribution(df, df, ["x"], "k", lambda d: d.withColumn("prediction", F.col("x")), n_draws=8)
    mean = phi.agg(F.avg("phi")).first()[0]
    assert abs(mean) < 15                                    # mean of f minus mean of draws: 500 x 8 x 2 / 2 draws


def test_errors_of_drawn_attributions(spark):
    """Exact values lie within a few standard errors, errors shrink with the root of the draws, phis stay as without."""
    from immolytics.operators.tree_attribution import product_attribution
    df = spark.range(400).select(F.col("id").cast("string").alias("k"), (F.col("id") % 17).cast("double").alias("a"),
                                 (F.col("id") % 23).cast("double").alias("b"), (F.col("id") % 5).cast("double").alias("c"))
    feats = ["a", "b", "c"]
    scorer = lambda d: d.withColumn("prediction", F.col("a") * F.col("b"))
    rows = df.where("k % 4 = 1")
    exact = {(r["k"], r["feature"]): r["phi"]
             for r in product_attribution(rows, df, [(1.0, ("a", "b"))], feats, "k").collect()}
    means = {}
    for n in (10, 40):
        got = attribution.shapley_attribution(rows, df, feats, "k", scorer, n_pairs=2, n_draws=n, errors=True).collect()
        assert len(got) == 300 and {r["error"] for r in got if r["feature"] == "c"} == {0.0}
        live = [r for r in got if r["feature"] != "c"]
        near = [abs(r["phi"] - exact[r["k"], r["feature"]]) <= 2.5 * r["error"] for r in live]
        assert sum(near) / len(near) > 0.93
        means[n] = sum(r["error"] for r in live) / len(live)
    assert 1.7 < means[10] / means[40] < 2.3
    plain = {(r["k"], r["feature"]): r["phi"] for r in attribution.shapley_attribution(
        rows, df, feats, "k", scorer, n_pairs=2, n_draws=40).collect()}
    assert all(r["phi"] == pytest.approx(plain[r["k"], r["feature"]], abs=1e-9) for r in got)
    one = attribution.shapley_attribution(rows, df, feats, "k", scorer, n_pairs=1, n_draws=1, errors=True)
    assert one.where("error IS NOT NULL").count() == 0
