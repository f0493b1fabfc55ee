"""One-hot encoding through a category table, against the wide form and at 200,000 categories."""

import pytest
from pyspark.sql import functions as F

from immolytics.operators import categories as C, encode, model
from immolytics.plans.training import split_and_encode

from .fixtures import prepared_pdf

COLUMNS = ["type_batiment", "nom_region"]


@pytest.fixture
def prepared(spark):
    return spark.createDataFrame(prepared_pdf())


def wide(rows, table, names):
    """{key: {feature name: 1}} of sparse rows."""
    name = {r.feature: f"{r.column_name}_{r.category}" for r in table.table.collect() if r.feature is not None}
    assert sorted(name) == list(range(table.n_features)) and [name[i] for i in sorted(name)] == names
    return {r.id_transaction: {name[i] for i in r.indicators["indices"]} for r in rows}


def test_same_indicators_as_the_wide_form(spark, prepared):
    strange = prepared.limit(1).withColumn("id_transaction", F.lit("x")).withColumn("nom_region", F.lit("nowhere")) \
                      .withColumn("type_batiment", F.lit(None).cast("string"))
    rows = prepared.withColumn("id_transaction", F.col("id_transaction").cast("string")).unionByName(
        strange.withColumn("id_transaction", F.lit("x")))
    table, dense = C.fit_categories(prepared, COLUMNS), encode.fit_one_hot(prepared, COLUMNS)
    got = C.transform_sparse(rows, table).collect()
    want = encode.transform_one_hot(rows, dense).collect()
    names = dense.all_feature_names
    assert wide(got, table, names) == {r.id_transaction: {n for n in names if r[n] == 1} for r in want}
    assert wide(got, table, names)["x"] == set()
    assert all(r.indicators["size"] == len(names) and r.indicators["values"] == [1.0] * len(r.indicators["indices"])
               and r.indicators["indices"] == sorted(r.indicators["indices"]) for r in got)
    assert set(got[0].asDict()) == (set(rows.columns) - set(COLUMNS)) | {"indicators"}


def test_inverse_store_and_vector(spark, prepared, tmp_path):
    table = C.fit_categories(prepared, COLUMNS)
    table.save(str(tmp_path / "t"))
    loaded = C.CategoryTable.load(spark, str(tmp_path / "t"))
    assert loaded.sizes == table.sizes and list(loaded.sizes) == COLUMNS
    assert sorted(map(tuple, loaded.table.collect())) == sorted(map(tuple, table.table.collect()))
    sparse = C.transform_sparse(prepared, loaded)
    back = C.inverse_sparse(C.inverse_sparse(sparse, loaded, "nom_region"), loaded, "type_batiment")
    key = ["id_transaction", *COLUMNS]
    assert sorted(map(tuple, back.select(key).collect())) == sorted(map(tuple, prepared.select(key).collect()))
    for r in sparse.withColumn("v", C.as_vector("indicators", table.n_features)).collect():
        assert r.v.size == table.n_features and list(r.v.indices) == r.indicators["indices"] and set(r.v.values) <= {1.0}


def test_empty_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "a")], "id int, p string, q string")
    table = C.fit_categories(df, ["p", "q"])
    assert table.sizes == {"p": 0, "q": 1} and table.n_features == 0
    assert [r.indicators["indices"] for r in C.transform_sparse(df, table).collect()] == [[], []]
    none = C.fit_categories(df.limit(0), ["q"])
    assert none.sizes == {"q": 0} and C.transform_sparse(df, none).count() == 2
    with pytest.raises(ValueError):
        C.fit_categories(df, ["missing"])


def test_two_hundred_thousand_categories_and_a_hot_one(spark):
    n = 200_000
    ids = spark.range(n).select(F.format_string("c%06d", "id").alias("c"), F.col("id").cast("string").alias("id_transaction"))
    hot = spark.range(n // 2).select(F.lit("c000007").alias("c"), F.concat(F.lit("h"), "id").alias("id_transaction"))
    unknown = spark.range(3).select(F.lit("new").alias("c"), F.concat(F.lit("u"), "id").alias("id_transaction"))
    table = C.fit_categories(ids.unionByName(hot), ["c"])
    assert table.sizes == {"c": n} and table.n_features == n - 1 and n > C.MOST_BROADCAST
    t = table.table
    assert t.where(F.col("position") != F.substring("category", 2, 6).cast("long")).count() == 0
    assert t.where(~F.col("feature").eqNullSafe(F.when(F.col("position") > 0, F.col("position") - 1))).count() == 0
    rows = ids.unionByName(hot).unionByName(unknown)
    kind = F.substring("id_transaction", 1, 1)
    want = F.when(kind == "h", 6).when(kind == "u", None).otherwise(F.col("id_transaction").try_cast("long") - 1)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (limit, "-1"):                        # Spark's own choice by size, and the shuffled join
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            out = C.transform_sparse(rows, table)
            active = out.select("id_transaction", F.get("indicators.indices", F.lit(0)).alias("f"))
            assert ("SortMergeJoin" in out._jdf.queryExecution().toString()) == (threshold == "-1")
            assert active.count() == n + n // 2 + 3
            assert active.where(~F.col("f").cast("long").eqNullSafe(F.when(want >= 0, want))).count() == 0
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_split_and_train_on_sparse_indicators(spark, prepared):
    out = split_and_encode(prepared, "en_dessous_du_marche", "prix", COLUMNS, key_columns=["id_transaction"], sparse=True)
    assert (out["train"].count(), out["test"].count()) == (8, 2)
    assert out["features"][-1] == "indicators" and not set(COLUMNS) & set(out["features"])
    fitted = model.train_price_model(out["train"], out["features"], maxIter=2)
    assert all(r.prediction > 0 for r in model.score(fitted, out["test"]).collect())


def test_large_dictionary_is_never_broadcast(spark, monkeypatch):
    monkeypatch.setattr(C, "MOST_BROADCAST", 2)
    monkeypatch.setattr(C, "MOST_BROADCAST_BYTES", 1000)
    df = spark.range(300).select("id", (F.col("id") % 100).cast("string").alias("part"))
    table = C.fit_categories(df, ["part"])
    sparse = C.transform_sparse(df, table)
    back = C.inverse_sparse(sparse, table, "part")
    for out in (sparse, back):
        rows = out.collect()                                  # the plan that ran, not the first one
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert len(rows) == 300 and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert {r.id: r.part for r in back.collect()} == {i: str(i % 100) for i in range(300)}
