import pytest
from pyspark.sql import functions as F

from immolytics.operators import drift

from .conftest import SF


def test_events_golden(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ref, cur = ev.where(F.col("event_id") % 10 < 8), ev.where(F.col("event_id") % 10 >= 8)
    rep = {r["column_name"]: r for r in drift.data_drift(ref, cur, ["value"], ["event_type"]).collect()}
    assert rep["value"]["ks"] == pytest.approx(0.02225, abs=1e-9)
    assert rep["value"]["wasserstein"] == pytest.approx(1.434215, abs=1e-6)
    assert rep["event_type"]["jensen_shannon"] == pytest.approx(0.0258858041, abs=1e-9)


def test_narrow_wide_and_negative_columns_match_sorting(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    columns = {"narrow": 1e6 + rng.random(900), "wide": rng.standard_normal(900) * 10.0 ** rng.integers(-8, 9, 900),
               "few": rng.integers(-2, 3, 900).astype(float)}
    ref = rng.random(900) < 0.6
    df = spark.createDataFrame([(bool(r), *map(float, v)) for r, *v in zip(ref, *columns.values())],
                               f"{drift.REF} boolean, narrow double, wide double, few double")
    rep = {r["column_name"]: r for r in drift.drift_of(df, list(columns), []).collect()}
    for name, v in columns.items():
        grid = np.unique(v)
        f = (np.searchsorted(np.sort(v[ref]), grid, side="right") / ref.sum(),
             np.searchsorted(np.sort(v[~ref]), grid, side="right") / (~ref).sum())
        assert rep[name]["ks"] == pytest.approx(np.abs(f[0] - f[1]).max(), abs=1e-12)
        assert rep[name]["wasserstein"] == pytest.approx((np.abs(f[0] - f[1])[:-1] * np.diff(grid)).sum(), rel=1e-9)
        assert rep[name]["wasserstein_norm"] == pytest.approx(rep[name]["wasserstein"] / max(v[ref].std(), 0.001), rel=1e-9)


def test_one_scan_of_the_rows(spark, tmp_path):
    path = str(tmp_path / "e.parquet")
    spark.read.parquet(f"{SF}/events.parquet").withColumn(drift.REF, F.col("event_id") % 5 > 0).write.parquet(path)
    rep = drift.drift_of(spark.read.parquet(path), ["value", "user_id"], ["event_type"])
    rep.collect()
    plan = rep._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final      # the counts are shuffled once


def test_self_drift_is_zero_and_gate(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    rep = drift.data_drift(ev, ev, ["value", "user_id"], ["event_type"])
    for r in rep.collect():
        assert r["score"] == pytest.approx(0.0, abs=1e-12) and not r["drifted"]
    s = drift.dataset_drift(rep).first()
    assert s["drifted_features"] == 0 and not s["stop"]
    drift.drift_gate(drift.dataset_drift(rep))
    shifted = ev.withColumn("value", F.col("value") + 1000)
    rep2 = drift.data_drift(ev, shifted, ["value"], ["event_type"])
    assert drift.dataset_drift(rep2).first()["drifted_features"] == 1
    assert drift.top_drifted(rep2, 1).first()["column_name"] == "value"


def test_slices_follow_the_values(spark):
    """All values in a sixteenth of an octave, and one outlier: no slice holds more than twice the mean."""
    rows = spark.range(20_000).select(F.lit("x").alias("column_name"), (1.0 + F.col("id") / 1e7).alias("value"))
    rows = rows.union(spark.createDataFrame([("x", 1e300), ("x", -5.0)], rows.schema))
    sizes = [r["count"] for r in drift.sliced(rows, 64).groupBy("s").count().collect()]
    assert len(sizes) == 64 and max(sizes) <= 2 * 20_002 / 64
    few = spark.createDataFrame([("y", float(v)) for v in (3, 1, 2)], "column_name string, value double")
    got = {r["value"]: r["s"] for r in drift.sliced(few, 8).collect()}
    assert got[1.0] < got[2.0] < got[3.0]


def test_state_gives_the_scores_of_the_rows_without_them(spark, tmp_path):
    import shutil

    from immolytics.operators.drift_state import DriftState
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    days = sorted(r["day"] for r in ev.select("day").distinct().collect())
    new = days[-1]
    source = str(tmp_path / "old")
    ev.where(F.col("day") < new).write.parquet(source)
    old = spark.read.parquet(source)
    want = {r["column_name"]: r for r in drift.data_drift(old, ev.where(F.col("day") == new), ["value", "user_id"], ["event_type"]).collect()}
    state = DriftState(spark, str(tmp_path / "state"))
    args = ("day", ["value", "user_id"], ["event_type"])
    assert state.add("a", old.where("event_id % 2 = 0"), *args) and state.add("b", old.where("event_id % 2 = 1"), *args)
    assert not state.add("b", old, *args)                                   # a repeated batch counts once
    shutil.rmtree(source)                                                   # the reference rows are gone
    assert state.add("c", ev.where(F.col("day") == new), *args)
    report = state.drift(F.col("period") < new, F.col("period") == new)
    got = {r["column_name"]: r for r in report.collect()}
    assert set(got) == set(want)
    for name, r in want.items():
        for c in ("ks", "wasserstein", "wasserstein_norm", "jensen_shannon", "chi2", "score"):
            assert got[name][c] == (None if r[c] is None else pytest.approx(r[c], rel=1e-9, abs=1e-12))
    assert "state" in "".join(report.inputFiles()) and all("/state/" in f for f in report.inputFiles())
