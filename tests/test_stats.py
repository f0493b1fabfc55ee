import numpy as np
import pytest
from pyspark.sql import functions as F

from immolytics.operators import stats


@pytest.fixture
def small(spark):
    rows = [(float(x), "a" if x % 3 else "b", int(x % 2)) for x in range(100)]
    return spark.createDataFrame(rows, "x double, c string, t int")


def test_histogram_matches_numpy_and_density(small):
    h = stats.histogram(small, ["x"], bins=7, density=True).orderBy("bin").collect()
    counts, edges = np.histogram(np.arange(100.0), bins=7)
    assert [r["n"] for r in h] == list(counts)              # max folded into the last bin
    assert h[0]["bin_lo"] == pytest.approx(edges[0]) and h[-1]["bin_hi"] == pytest.approx(edges[-1])
    dens, _ = np.histogram(np.arange(100.0), bins=7, density=True)
    assert [r["density"] for r in h] == pytest.approx(list(dens))
    by = stats.histogram(small, ["x"], bins=7, by="t").groupBy("t").agg(F.sum("n").alias("s")).collect()
    assert {r["t"]: r["s"] for r in by} == {0: 50, 1: 50}


def test_zero_bins_and_crosstab_zeros(spark):
    df = spark.createDataFrame([(0.0, "a", 0), (10.0, "a", 0), (10.0, "b", 0)], "x double, c string, t int")
    h = stats.histogram(df, ["x"], bins=5).orderBy("bin").collect()
    assert [r["n"] for r in h] == [1, 0, 0, 0, 2]
    ct = {r["c"]: (r["n_0"], r["n_1"]) for r in stats.crosstab(df, "c", "t", [0, 1]).collect()}
    assert ct == {"a": (2, 0), "b": (1, 0)}


def test_kde_integrates_to_one(small):
    k = stats.kde(small, ["x"], grid_size=400).orderBy("g").collect()
    xs = np.array([r["x"] for r in k])
    ys = np.array([r["density"] for r in k])
    assert np.trapezoid(ys, xs) == pytest.approx(1.0, abs=0.01)


def test_categorical_profile(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), ("c",), (None,)], "s string")
    d = stats.describe_categorical(df, ["s"]).first()
    assert (d["count"], d["unique"], d["top"], d["freq"]) == (5, 3, "a", 2)   # tie -> smallest value
    vc = stats.value_counts(df, ["s"]).collect()
    assert sum(r["share"] for r in vc) == pytest.approx(1.0)
    assert {r["value"]: r["n"] for r in vc} == {"a": 2, "b": 2, "c": 1}


def test_boxplot_fences(spark):
    vals = list(range(1, 21)) + [100]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    b = stats.boxplot_stats(df, ["x"]).first()
    q1, q3 = np.percentile(vals, [25, 75])
    assert (b["q1"], b["q3"]) == (pytest.approx(q1), pytest.approx(q3))
    assert b["n_outliers"] == 1 and b["whisker_hi"] == 20.0 and b["whisker_lo"] == 1.0


def test_grid_counts_total(small):
    g = stats.grid_counts(small, "x", "t", bins=4)
    assert g.agg(F.sum("n")).first()[0] == 100
    assert g.agg(F.max("x_bin")).first()[0] == 4


def test_correlation_mixed_and_empty_pairs(spark):
    rows = [(float(i), 2.0 * i + (i % 3), None if i % 2 else float(i % 5), None) for i in range(60)]
    df = spark.createDataFrame(rows, "x double, y double, z double, w double")
    got = {(r["col_a"], r["col_b"]): r["r"] for r in stats.correlation_matrix(df, ["x", "y", "z", "w"]).collect()}
    assert len(got) == 6 and got[("x", "w")] is None and got[("z", "w")] is None
    xs = np.array([r[0] for r in rows if r[2] is not None]); zs = np.array([r[2] for r in rows if r[2] is not None])
    assert got[("x", "z")] == pytest.approx(np.corrcoef(xs, zs)[0, 1], rel=1e-9)
    full = np.array([[r[0], r[1]] for r in rows])
    assert got[("x", "y")] == pytest.approx(np.corrcoef(full.T)[0, 1], rel=1e-9)


def test_eda_profile(spark):
    from immolytics.plans.eda import profile
    from .fixtures import transactions_pdf
    rep = profile(spark.createDataFrame(transactions_pdf()))
    assert rep["nulls"].count() == 17
    assert rep["describe_numeric"].count() == len([c for c, t in rep["nulls"].select("column_name", "data_type").collect()
                                                   if t in ("double", "bigint", "int")])
    assert rep["crosstab_ville"].count() == 2
    assert rep["strong_pairs"].count() >= 1


def test_no_shuffle_of_unpivoted_rows(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(3000).select((F.col("id") * 1.5).alias("x"), (F.col("id") % 17).cast("double").alias("y"),
                             (F.col("id") % 2).alias("g")).write.parquet(path)
    df = spark.read.parquet(path)
    for frame in (stats.histogram(df, ["x", "y"]), stats.histogram(df, ["x", "y"], by="g"), stats.kde(df, ["x", "y"]),
                  stats.boxplot_stats(df, ["x", "y"], by="g")):
        plan = frame._jdf.queryExecution().executedPlan().toString().splitlines()
        for i, line in enumerate(plan):
            if "Exchange hashpartitioning(column_name" in line:
                scan = next(k for k in range(i, len(plan)) if "FileScan" in plan[k])
                assert any("HashAggregate" in x for x in plan[i + 1:scan]), line       # counts, not rows


def test_kde_of_a_long_tail(spark):
    rng = np.random.default_rng(2)
    v = np.concatenate([rng.normal(0, 1, 4000), [1e4, -2e4]])          # a fixed grid of bins would be wider than the bulk
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    got = stats.kde(df, ["x"], grid_size=2000).collect()
    h = v.std(ddof=1) * len(v) ** -0.2
    most = max(r["density"] for r in got)
    for r in got:
        want = np.exp(-0.5 * ((r["x"] - v) / h) ** 2).sum() / (len(v) * h * np.sqrt(2 * np.pi))
        assert r["density"] == pytest.approx(want, rel=0.02, abs=0.05 * most)


def test_pair_grid_equals_one_pair_at_a_time(spark):
    import itertools

    import pytest

    from immolytics.operators import stats
    rows = [(float(i % 7), i * 0.5, -float(i % 3), 4.0) for i in range(200)] + [(None, 3.0, float("nan"), 4.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double")
    got = {}
    for r in stats.pair_grid(df, ["a", "b", "c", "k"], 6).collect():
        got.setdefault((r.x_column, r.y_column), {})[r.x_bin, r.y_bin] = r.n
    assert set(got) == set(itertools.combinations("abck", 2))
    complete = df.where("a IS NOT NULL AND NOT isnan(c)")
    for x, y in (("a", "c"), ("b", "k")):
        one = stats.grid_counts(complete if x == "a" else df, x, y, 6).collect()
        assert got[x, y] == {(r.x_bin, r.y_bin): r.n for r in one}
    with pytest.raises(ValueError):
        stats.pair_grid(df, ["a", "a"])
