import pytest
from pyspark.sql import functions as F

from immolytics.operators import features as feat
from immolytics.operators.columns import drop_existing

from .fixtures import transactions_pdf


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(transactions_pdf())


GOLDEN_CITY = [  # ville, mois, nb, ratio, flag, prev price, prev nb
    ("BOURG-EN-BRESSE", 1, 17, 65.384615, 1, None, None),
    ("BOURG-EN-BRESSE", 2, 12, 34.285714, 0, 1229.76, 17),
    ("BOURG-EN-BRESSE", 2, 15, 42.857143, 1, 1229.76, 12),
    ("BOURG-EN-BRESSE", 3, 14, 40.000000, 0, 1229.76, 15),
    ("DIVONNE-LES-BAINS", 1, 9, 34.615385, 0, None, None),
    ("DIVONNE-LES-BAINS", 2, 8, 22.857143, 0, 4512.42, 9),
    ("DIVONNE-LES-BAINS", 3, 10, 28.571429, 0, 4512.42, 8),
    ("DIVONNE-LES-BAINS", 3, 11, 31.428571, 0, 4512.42, 10),
]


def test_city_month_golden(sales):
    cm = feat.previous_month(feat.compute_city_features(feat.city_month(sales), grouped=True))
    rows = cm.orderBy("ville", "mois_transaction", "nb_transactions_mois").collect()
    assert len(rows) == 8
    for r, g in zip(rows, GOLDEN_CITY):
        assert (r["ville"], r["mois_transaction"], r["nb_transactions_mois"]) == g[:3]
        assert r["ratio_transaction"] == pytest.approx(g[3], abs=1e-6)
        assert r["ville_demandee"] == g[4]
        assert r["prix_m2_moyen_mois_precedent"] == (None if g[5] is None else pytest.approx(g[5]))
        assert r["nb_transactions_mois_precedent"] == g[6]
    assert {r["prix_m2_moyen"] for r in rows} == {1229.76, 4512.42}
    q = cm.select(F.percentile("ratio_transaction", 0.8)).first()[0]
    assert q == pytest.approx(41.714285714285715)


def test_city_features_dtypes(sales):
    cm = feat.compute_city_features(feat.city_month(sales), grouped=True)
    types = dict(cm.dtypes)
    assert types["ratio_transaction"] == "double" and types["prix_m2_moyen"] == "double"
    assert types["ville_demandee"] == "int"
    lag = feat.compute_features_price_per_m2(cm)
    types = dict(lag.dtypes)
    assert types["prix_m2_moyen_mois_precedent"] == "double"
    assert types["nb_transactions_mois_precedent"] == "bigint"
    assert lag.count() == 6


GOLDEN_PREPARED = sorted([
    (110000.0, 2, 1229.76, 17, 0), (110000.0, 2, 1229.76, 12, 1), (65000.0, 2, 1229.76, 17, 0),
    (65000.0, 2, 1229.76, 12, 1), (195000.0, 3, 1229.76, 15, 0), (220000.0, 2, 4512.42, 9, 0),
    (100000.0, 3, 4512.42, 8, 0), (100000.0, 3, 4512.42, 10, 0), (69000.0, 3, 4512.42, 8, 0),
    (69000.0, 3, 4512.42, 10, 0)])


def test_feature_engineering_fan_out(sales):
    out = feat.feature_engineering(sales)
    got = sorted((r["prix"], r["mois_transaction"], r["prix_m2_moyen_mois_precedent"],
                  r["nb_transactions_mois_precedent"], r["ville_demandee"]) for r in out.collect())
    assert got == GOLDEN_PREPARED
    assert len(out.columns) == 13
    for c in ["nom_departement", "id_ville", "ville", "prix_m2", "prix_m2_moyen", "nb_transactions_mois", "n_pieces"]:
        assert c not in out.columns


def test_one_row_per_city_month(sales):
    out = feat.feature_engineering(sales, one_row_per_city_month=True)
    # the row of the largest volume: 15 of Bourg in February (before it 12), 11 of Divonne in March (before it 10)
    got = sorted((r["prix"], r["mois_transaction"], r["nb_transactions_mois_precedent"], r["ville_demandee"]) for r in out.collect())
    assert got == [(65000.0, 2, 12, 1), (69000.0, 3, 10, 0), (100000.0, 3, 10, 0), (110000.0, 2, 12, 1),
                   (195000.0, 3, 15, 0), (220000.0, 2, 9, 0)]


def test_raw_rows_are_grouped_first(sales):
    raw = feat.compute_city_features(sales)
    assert raw.count() == 8
    total = {(r["mois_transaction"], r["nb_transactions_departement"]) for r in raw.collect()}
    assert total == {(1, 26), (2, 35), (3, 35)}
    rounded = feat.compute_city_features(feat.city_month(sales), grouped=True)
    assert rounded.select("ville_demandee").collect() and rounded.count() == 8


def test_split_of_fanned_out_rows_is_exact(sales):
    from immolytics.operators import splits
    from immolytics.settings import LINE_KEY
    keyed = sales.withColumn("id_transaction", F.concat(F.col("prix").cast("string"), F.lit("-"), F.col("surface_habitable")))
    lines = feat.feature_engineering(keyed, line_key_of="id_transaction").select(LINE_KEY).cache()
    assert lines.count() == lines.distinct().count() == 10
    for seed in range(100):
        sizes = {r["split"]: r["count"] for r in splits.with_split(lines, [LINE_KEY], seed=seed).groupBy("split").count().collect()}
        assert sizes == {"train": 8, "test": 2}


def test_empty_input_raises(sales):
    with pytest.raises(ValueError, match="empty"):
        feat.feature_engineering(sales.limit(0))


def test_rolling_mean_includes_current(spark):
    rows = [("D", "V", 1, 2020, m, 1, float(m)) for m in range(1, 9)]
    cm = spark.createDataFrame(rows, "nom_departement string, ville string, id_ville int, annee_transaction int, "
                                     "mois_transaction int, nb_transactions_mois bigint, prix_m2_moyen double")
    out = feat.rolling_means(cm, 6).orderBy("mois_transaction").collect()
    vals = [r["prix_m2_moyen_glissant_6m"] for r in out]
    assert vals[:5] == [None] * 5
    assert vals[5] == pytest.approx(3.5) and vals[7] == pytest.approx(5.5)
    prev = feat.rolling_means(cm, 6, exclude_current=True).orderBy("mois_transaction").collect()
    assert prev[6]["prix_m2_moyen_glissant_6m"] == pytest.approx(3.5)


def test_missing_column_raises(sales):
    with pytest.raises(ValueError):
        feat.feature_engineering(sales.drop("nb_transactions_mois"))
    with pytest.raises(KeyError):
        drop_existing(sales, ["nope"])


def test_prepared_set_of_written_columns_joins_once(spark):
    from immolytics.plans.binding import prepared
    from immolytics.settings import ROW_KEY
    sf = "/root/testdata/sf0.001"
    columns = [ROW_KEY, "prix", "vefa", "surface_habitable"]
    got, want = prepared(spark, sf, columns), prepared(spark, sf)
    assert set(got.columns) == set(want.columns) - {"type_batiment", "latitude", "longitude", "nom_region"}
    assert not any("lineitem" in f or "orders" in f for f in got.inputFiles()) and any("lineitem" in f for f in want.inputFiles())
    assert got.count() == want.count() > 0
    names = [c for c in got.columns if c != "en_dessous_du_marche"]
    floats = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in want.select(*names).dtypes]
    assert got.select(*floats).exceptAll(want.select(*floats)).isEmpty()
