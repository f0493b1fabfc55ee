from pyspark.sql import functions as F

from immolytics.operators import columns as cols, stats
from immolytics.session import materialize, path_exists
from immolytics.sources.snapshot import reference_and_current


def test_reference_snapshot_write_once(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("v"))
    path = str(tmp_path / "reference.parquet")
    ref, cur = reference_and_current(spark, df, path, ["k"])
    assert path_exists(spark, path)
    assert (ref.count(), cur.count()) == (800, 200)
    assert ref.join(cur, "k").count() == 0
    ref2, cur2 = reference_and_current(spark, df, path, ["k"])   # second run: stored reference vs all rows
    assert (ref2.count(), cur2.count()) == (800, 1000)


def test_column_selection_and_alignment(spark):
    df = spark.createDataFrame([(1, 0, 2.5, "a"), (2, 1, 3.5, "b"), (3, 0, 4.5, "a")],
                               "n int, flag int, x double, s string")
    assert cols.numeric_columns(df) == ["n", "flag", "x"]
    assert cols.categorical_columns(df) == ["s"]
    assert cols.continuous_columns(df) == ["n", "x"]
    al = cols.align_columns(df, ["x", "missing", "n"])
    assert al.columns == ["x", "missing", "n"] and al.first()["missing"] == 0
    assert cols.keep_known_columns(df, ["s", "zz", "n"]).columns == ["s", "n"]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    prof = stats.null_profile(df).first()
    assert prof["n_null"] == 2
    assert cols.drop_incomplete(df).count() == 1
    assert cols.nan_to_null(df).where(F.col("x").isNull()).count() == 2
    d = stats.describe_numeric(df).first()
    assert d["count"] == 1 and d["mean"] == 1.0


def test_materialize_reads_back(spark):
    df = spark.range(10)
    m = materialize(df, "t")
    assert m.count() == 10
    assert all(f.endswith(".parquet") for f in m.inputFiles())


def test_correlation_paths_and_constant_column(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    x = rng.normal(size=300)
    rows = [(float(a), float(2 * a + rng.normal() * 0.1), 7.0, float(b)) for a, b in zip(x, rng.normal(size=300))]
    df = spark.createDataFrame(rows, "x double, y double, c double, z double")
    want = np.corrcoef(np.array([[r[0], r[1], r[3]] for r in rows]).T)
    for frame in (df, df.union(spark.createDataFrame([(None, 1.0, 7.0, 0.5)], df.schema))):
        got = {(r["col_a"], r["col_b"]): r["r"] for r in stats.correlation_matrix(frame, ["x", "y", "c", "z"]).collect()}
        assert got[("x", "c")] is None and got[("c", "z")] is None
        assert abs(got[("x", "y")] - want[0, 1]) < 1e-9 or frame is not df
        assert abs(got[("x", "z")] - want[0, 2]) < 1e-9 or frame is not df
    pairs = stats.strong_pairs(stats.correlation_matrix(df, ["x", "y", "z"]))
    assert [(r["col_a"], r["col_b"]) for r in pairs.collect()] == [("x", "y")]
