import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "ville_demandee" in df.columns and "prix" in df.columns


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


def test_scratch_is_removed_when_the_driver_exits(tmp_path):
    import os
    import subprocess
    import sys
    code = """
from immolytics.session import get_session, materialize
spark = get_session("local[1]", shuffle_partitions=1, conf={"spark.checkpoint.dir": %r})
print(materialize(spark.range(5), "t").count())
if %d:
    spark.stop()
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for stop in (0, 1):
        folder = tmp_path / f"shared{stop}"
        out = subprocess.run([sys.executable, "-c", code % (str(folder), stop)], cwd=root, capture_output=True, text=True, timeout=120)
        assert out.stdout.strip() == "5", out.stderr[-2000:]
        assert not [p for p in folder.rglob("*") if p.name.startswith("immolytics-")]
