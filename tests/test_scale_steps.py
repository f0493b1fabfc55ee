"""Steps whose figures must not grow faster than the tables: what is written, shuffled and sorted."""

import os

import pytest
from pyspark.sql import functions as F

from immolytics.operators import attribution, model as pm
from immolytics.plans import binding
from immolytics.plans.queries import q_fanout_split, two_volumes
from immolytics.sources import files

from .conftest import SF_SMALL


def plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("writer", [files.write_json, files.write_json_array])
def test_json_is_packed_and_read_back(spark, tmp_path, writer):
    df = spark.range(2000).select(F.col("id").cast("double").alias("prix"), F.lit("Lyon é\n").alias("ville"),
                                  F.when(F.col("id") % 3 == 0, F.col("id")).alias("id_ville"))
    path = writer(df, str(tmp_path / "out.json"))
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert parts and all(f.endswith(".gz") for f in parts)
    assert sum(os.path.getsize(f"{path}/{f}") for f in parts) < 2000 * 20
    back = files.load_table(spark, path, schema=df.schema).select(df.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_sales_are_not_shuffled_to_meet_the_market(spark):
    for sales in (binding.transactions(spark, SF_SMALL), two_volumes(spark, SF_SMALL)):
        text = sales._jdf.queryExecution().optimizedPlan().toString()
        market = text[text.index("Join Inner, (((("):]
        assert "Aggregate" not in market                                  # a written table, of known size


def test_fanned_out_lines_read_the_sales_once(spark, monkeypatch):
    made = []
    whole = binding.raw_transactions
    monkeypatch.setattr(binding, "raw_transactions", lambda *a: made.append(a) or whole(*a))
    lines = q_fanout_split(spark, SF_SMALL)
    assert len(made) == 1 and "lineitem" not in lines._jdf.queryExecution().optimizedPlan().toString()
    assert set(lines.columns) == {"id_ligne", "nb_transactions_mois_precedent", "split"}


def test_top_of_wide_rows(spark):
    nan = float("nan")
    rows = [("a", 1.0, -3.0, 3.0, 0.0), ("b", nan, None, 2.0, -2.5), (None, 0.0, 0.0, -0.0, None), ("d", 5.0, 4.0, 1.0, 2.0),
            ("d", 5.0, -6.0, 0.5, 2.0), (None, 7.0, 1.0, None, None)]
    wide = spark.createDataFrame(rows, "k string, z double, `b.1` double, a double, c double")
    long = wide.unpivot(["k"], ["z", "`b.1`", "a", "c"], "feature", "phi")
    for k in (1, 2, 3, 6):
        want = attribution.top_attributions(long, "k", k)
        got = attribution.top_attributions(wide, "k", k, wide=True)
        assert got.columns == want.columns and got.schema["rank"].dataType == want.schema["rank"].dataType
        key = lambda df: sorted(str((r.k, r["rank"], r.feature, r.phi if r.phi != 0 else 0.0)) for r in df.collect())
        assert key(got) == key(want)
    text = plan(attribution.top_attributions(wide, "k", 2, wide=True))
    assert text.count("+- Sort") == text.count("Window ") and "WindowGroupLimit" not in text


def test_training_rows_are_dealt_evenly(spark, monkeypatch):
    df = spark.range(0, 4000, 1, 1).select((F.col("id") % 40).cast("double").alias("x.1"), (F.col("id") % 400).cast("double").alias("prix"))
    assert pm.in_even_parts(df) is df
    parts = pm.in_even_parts(df, 400).groupBy(F.spark_partition_id()).count().collect()
    assert pm.in_even_parts(df, 400).count() == 4000 and len(parts) > 5 and max(r["count"] for r in parts) < 1200
    seen = []
    even = pm.in_even_parts
    monkeypatch.setattr(pm, "in_even_parts", lambda train, *a: seen.append(train.columns) or even(train, 400))
    fitted = pm.train_price_model(df.withColumnRenamed("x.1", "x"), ["x"], maxIter=2)
    assert seen == [["x", "prix"]] and pm.score(fitted, df.withColumnRenamed("x.1", "x")).where("prediction IS NULL").count() == 0
