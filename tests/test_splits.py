import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from immolytics.operators import splits


@pytest.fixture
def skewed(spark):
    random.seed(3)
    # a third of the rows share one month: the order key must split them by the row key
    rows = [(i, 2020, 1 if i % 3 == 0 else random.randint(1, 12), f"k{i:05d}") for i in range(3000)]
    return spark.createDataFrame(rows, "i int, annee int, mois int, key string")


def brute_rank(pdf, cols):
    return pdf.sort_values(cols, kind="mergesort").reset_index(drop=True)


def test_rank_cuts_match_brute_force(spark, skewed):
    pdf = brute_rank(skewed.toPandas(), ["annee", "mois", "key"])
    key = splits.order_key(skewed, ["annee", "mois", "key"])
    ranks = [1, 17, 999, 1000, 2500, 3000]
    cuts = splits.rank_cuts(skewed, key, ranks, chunk=2, final_limit=7)
    for r in ranks:
        flagged = skewed.where(key <= F.lit(cuts[r])).select("key").toPandas()["key"]
        assert set(flagged) == set(pdf["key"][:r])


def test_hash_split_exact_disjoint(spark, skewed):
    s = splits.with_split(skewed, ["key"], 0.2, 42)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"test": math.ceil(0.2 * 3000), "train": 3000 - math.ceil(0.2 * 3000)}
    again = splits.with_split(skewed.repartition(7), ["key"], 0.2, 42)
    assert s.where("split = 'test'").select("key").subtract(again.where("split = 'test'").select("key")).count() == 0
    ref = splits.sample_reference(skewed, ["key"])
    assert ref.where("dataset = 'reference'").count() == round(0.8 * 3000)


def test_folds_never_look_ahead(spark, skewed):
    b = splits.time_series_blocks(skewed, ["annee", "mois", "key"], 5)
    pdf = b.toPandas().sort_values(["annee", "mois", "key"]).reset_index(drop=True)
    assert pdf["block"].is_monotonic_increasing
    assert list(pdf["block"].value_counts().sort_index()) == [500] * 6
    for i in range(1, 6):
        tr, te = splits.fold(b, i)
        assert tr.agg(F.max("i")).first() is not None
        last_train = pdf[pdf.block < i].index.max()
        first_test = pdf[pdf.block == i].index.min()
        assert last_train < first_test
    k = splits.k_folds(skewed, ["i"], 7).groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in k] == [429] * 4 + [428] * 3


def test_halves_and_temporal(spark, skewed):
    h = splits.positional_halves(skewed, ["i"])
    assert h.where("dataset = 'reference'").agg(F.max("i")).first()[0] == 1499
    t = splits.temporal_split(skewed, ["annee", "mois", "key"], 0.8)
    assert t.where("dataset = 'reference'").count() == 2400
    assert splits.complement(skewed, h.where("dataset = 'reference'"), ["i"]).count() == 1500


def test_exact_quantiles_match_percentile(spark):
    from immolytics.operators.quantiles import quantile_columns, quantile_scalar
    random.seed(1)
    base = [-1e-300, -2.5, -1e20, 0.0, -0.0, 3.0, 1e-310, 7.25, 1e300, 123456.789, math.inf, -math.inf]
    vals = [random.choice(base) * random.random() for _ in range(2000)] + [5.0] * 1000   # a hot value
    vals += [1e6 + random.random() for _ in range(500)]                                  # a narrow range
    rows = [(("a" if i % 3 else "bb") if i % 7 else None, v) for i, v in enumerate(vals)] + [("one", 4.0)]
    df = spark.createDataFrame(rows + [("empty", None), ("empty", math.nan)], "g string, x double")
    probs, names = [0.0, 0.25, 0.5, 0.8, 1.0], list("abcde")
    clean = df.where(~F.isnan("x") & F.col("x").isNotNull())
    exact = F.percentile("x", F.array(*[F.lit(p) for p in probs])).alias("q")
    got = {r.g: list(r)[1:] for r in quantile_columns(df, "x", probs, names, ["g"]).collect()}
    want = {r.g: r.q for r in clean.groupBy("g").agg(exact).collect()}
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12, abs=1e-300)
    assert list(quantile_columns(df, "x", probs, names).first()) == pytest.approx(clean.agg(exact).first()[0], rel=1e-12)
    assert df.select(quantile_scalar(df, "x", 0.5)).first()[0] == clean.agg(F.percentile("x", 0.5)).first()[0]
    assert quantile_columns(df.limit(0), "x", [0.5], ["m"], ["g"]).collect() == []


def test_quantiles_scan_the_rows_once(spark, tmp_path):
    from immolytics.operators.quantiles import quantile_columns
    path = str(tmp_path / "t.parquet")
    spark.range(3000).select((F.col("id") % 3).alias("g"), F.rand(1).alias("x")).write.parquet(path)
    got = quantile_columns(spark.read.parquet(path), "x", [0.1, 0.5], ["a", "b"], ["g"])
    assert got.count() == 3 and got.collect()
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1


def test_quantiles_of_many_groups(spark):
    from immolytics.operators.quantiles import quantile_columns
    df = spark.range(600_000).select((F.col("id") % 200_000).alias("g"), F.col("id").cast("double").alias("x"))
    got = quantile_columns(df, "x", [0.5], ["m"], ["g"])
    assert got.agg(F.count("*"), F.sum(F.abs(F.col("m") - F.col("g") - 200_000))).first()[:2] == (200_000, 0.0)


def test_equal_keys_at_a_cut_are_an_error(spark):
    df = spark.createDataFrame([(k,) for k in ["a", "b", "b", "b", "c"]], "key string")
    with pytest.raises(ValueError, match="not unique"):
        splits.rank_cuts(df, splits.order_key(df, ["key"]), [2])
    cuts = splits.rank_cuts(df, splits.order_key(df, ["key"]), [1, 4])       # no tie is cut here
    assert len(cuts) == 2
    long = df.unionByName(df).unionByName(df)
    with pytest.raises(ValueError, match="not unique"):
        splits.rank_cuts(long, splits.order_key(long, ["key"]), [5], final_limit=1)


def test_group_folds_keep_groups_together(spark):
    df = spark.range(1000).select((F.col("id") % 37).alias("g"))
    folds = splits.group_folds(df, ["g"], 4).distinct().collect()
    assert len(folds) == 37 and {r.fold for r in folds} == {0, 1, 2, 3}


def test_split_plan_is_a_filter(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(20000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 5).alias("v")) \
        .write.parquet(path)
    df = spark.read.parquet(path)
    plan = splits.with_split(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan


def test_balanced_folds_differ_by_the_largest_group_at_most(spark):
    import random

    import pytest

    from immolytics.operators.splits import balanced_folds
    rng = random.Random(5)
    rows = [(g, i) for g in [None, *map(str, range(300))] for i in range(int(rng.paretovariate(0.8)) % 400 + 1)]
    df = spark.createDataFrame(rows, "g string, i int")
    got = balanced_folds(df, ["g"], 4).collect()
    assert sorted((r.g or "", r.i) for r in got) == sorted((g or "", i) for g, i in rows)
    of_group, sizes = {}, [0] * 4
    for r in got:
        of_group.setdefault(r.g, set()).add(r.fold)
        sizes[r.fold] += 1
    largest = max(sum(1 for g, _ in rows if g == name) for name in of_group)
    assert all(len(f) == 1 for f in of_group.values()) and max(sizes) - min(sizes) <= largest
    with pytest.raises(ValueError):
        balanced_folds(df, ["g"], 1)


def test_only_rows_of_the_values_at_a_rank_are_ranked(spark, monkeypatch):
    rows = [(2000 + i // 12 % 3, 1 + i * 7 % 12, None if i % 250 == 0 else f"k{i * 37 % 6000:05d}") for i in range(6000)] + [(None, 3, "x"), (2001, None, "y")]
    df = spark.createDataFrame(rows, "annee int, mois int, key string").repartition(4)
    ranked, cuts_at = [], splits.cuts_at
    monkeypatch.setattr(splits, "cuts_at", lambda rows, *a: ranked.append(rows.count()) or cuts_at(rows, *a))

    def both():
        return [sorted(f.collect(), key=str) for f in (splits.time_series_blocks(df, ["annee", "mois", "key"], 5), splits.k_folds(df, ["annee", "mois", "key"], 4))]

    got = both()
    assert len(ranked) == 2 and max(ranked) < 2000
    monkeypatch.setattr(splits, "LEADS", 3)                             # too many values of the leading columns: all rows are ranked
    assert both() == got and ranked[2:] == [6002, 6002]
    twice = df.unionByName(df)
    for leads in (3, 100):
        monkeypatch.setattr(splits, "LEADS", leads)
        with pytest.raises(ValueError, match="not unique at rank"):
            splits.time_series_blocks(twice.where("key = 'k00037' or key = 'k00001'"), ["annee", "mois", "key"], 3)
