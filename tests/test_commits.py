"""Commit protocols: write-once snapshot (S8) and versioned run log."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from immolytics.sources import commits
from immolytics.sources.runlog import RunLog, latest_run
from immolytics.sources.snapshot import reference_and_current


def keyed(spark, n=50, add=0):
    return spark.range(n).select(F.format_string("k%03d", "id").alias("k"), (F.col("id") + add).alias("v"))


def test_killed_first_write_is_no_reference(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "reference")
    df = keyed(spark)
    monkeypatch.setattr(commits, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        reference_and_current(spark, df, path, ["k"])
    monkeypatch.undo()
    assert not os.path.exists(path) and len(os.listdir(tmp_path)) == 1       # a staged folder, never read
    ref, cur = reference_and_current(spark, df, path, ["k"])
    assert ref.count() == 40 and cur.count() == 10
    again, everything = reference_and_current(spark, df, path, ["k"], verify=True)
    assert sorted(again.collect()) == sorted(ref.collect()) and everything.count() == 50


def test_half_written_folders_are_refused(spark, tmp_path):
    path = str(tmp_path / "reference")
    keyed(spark).write.parquet(path)                                        # rows, but no manifest
    with pytest.raises(RuntimeError, match="no committed table"):
        reference_and_current(spark, keyed(spark), path, ["k"])
    other = str(tmp_path / "other")
    reference_and_current(spark, keyed(spark), other, ["k"])
    part = next(f for f in os.listdir(other) if f.endswith(".parquet"))
    os.remove(os.path.join(other, part))
    with pytest.raises(RuntimeError, match="rows of its manifest"):
        reference_and_current(spark, keyed(spark), other, ["k"], verify=True)


def test_two_first_writers_leave_one_whole_reference(spark, tmp_path):
    path = str(tmp_path / "reference")
    staged = [commits.stage(keyed(spark, add=a), path) for a in (0, 1000, 2000)]
    with ThreadPoolExecutor(3) as pool:
        won = list(pool.map(lambda s: commits.commit(spark, s, path), staged))
    assert sum(won) == 1
    values = {r.v // 1000 for r in commits.read(spark, path, verify=True).collect()}
    assert values == {won.index(True)} and os.listdir(tmp_path) == ["reference"]
    assert not any(n.startswith("_staged") for n in os.listdir(path))
    ref, cur = reference_and_current(spark, keyed(spark), path, ["k"])
    assert ref.count() == 50 and cur.count() == 50


def test_a_run_is_seen_as_a_whole(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "runs"))
    assert log.table("runs").count() == 0 and log.version() == 0
    with log.run("training_a", {"Run_Type": "model_training"}, params={"depth": 5}) as run:
        run.log_metrics({"rmse": 1.5})
        run.log_metrics_frame(spark.createDataFrame([("mae", 1.0)], "k string, v double"), "k", "v")
        assert log.table("runs").count() == 0
    assert log.version() == 1
    assert {r.key: r.value for r in log.table("metrics").collect()} == {"rmse": 1.5, "mae": 1.0}
    with pytest.raises(ValueError):
        with log.run("training_b", {"Run_Type": "model_training"}) as run:
            run.log_metrics({"rmse": 9})
            raise ValueError
    assert log.version() == 1 and latest_run(log.table("runs"), log.table("tags")).first()["run_name"] == "training_a"
    with log.run("nested", parent_id=run.run_id):
        pass
    assert [r.parent_run_id for r in log.table("runs").where("run_name = 'nested'").collect()] == [run.run_id]
    assert log.table("runs", as_of=1).count() == 1


def test_writers_that_meet_lose_nothing(spark, tmp_path):
    root = str(tmp_path / "runs")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: RunLog(spark, root).start_run(f"r{i}", {"n": i}), range(12)))
    log = RunLog(spark, root)
    assert log.version() == 12 and {r.run_name for r in log.table("runs").collect()} == {f"r{i}" for i in range(12)}


def test_files_stay_bounded_and_old_versions_readable(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "runs"), compact_every=5)
    for i in range(32):
        log.start_run(f"r{i:02d}", {"n": i})
    assert len(os.listdir(tmp_path / "runs")) <= 2 * 5 + 2
    for version in (0, 3, 17, 25, 31, 32):
        assert sorted(r.run_name for r in log.table("runs", as_of=version).collect()) == [f"r{i:02d}" for i in range(version)]
    assert sorted(int(r.value) for r in log.table("tags").collect()) == list(range(32))
