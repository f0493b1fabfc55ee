import pytest
from pyspark.sql import functions as F

from immolytics.operators import encode, splits
from immolytics.operators.columns import require_columns
from immolytics.plans.training import split_and_encode

from .fixtures import prepared_pdf

KEY = ["id_transaction"]


@pytest.fixture
def prepared(spark):
    return spark.createDataFrame(prepared_pdf())


def test_exact_split_sizes(prepared):
    train, test = splits.train_test_split(prepared, KEY)
    assert (train.count(), test.count()) == (8, 2)
    assert train.join(test, KEY).count() == 0


def test_split_and_encode_indicators(prepared):
    out = split_and_encode(prepared, "en_dessous_du_marche", "prix", ["type_batiment", "nom_region"],
                           key_columns=KEY, seed=42)
    x_train, x_test = out["train"], out["test"]
    assert (x_train.count(), x_test.count()) == (8, 2)
    for c in ["type_batiment_Maison", "nom_region_Nouvelle-Aquitaine", "nom_region_Occitanie",
              "nom_region_Provence-Alpes-Côte d'Azur", "nom_region_Île-de-France"]:
        assert c in x_train.columns and c in x_test.columns
    assert "type_batiment" not in x_train.columns and "nom_region" not in x_train.columns
    assert set(out["encoders"].categories) == {"type_batiment", "nom_region"}
    assert dict(x_train.dtypes)["type_batiment_Maison"] == "int"


def test_unknown_column_message(prepared):
    with pytest.raises(ValueError, match="La colonne colonne_inexistante n'existe pas dans le DataFrame."):
        split_and_encode(prepared, "en_dessous_du_marche", "prix", ["colonne_inexistante"], key_columns=KEY)
    with pytest.raises(ValueError):
        require_columns(prepared, ["colonne_inexistante"])


def test_unknown_category_all_zero_and_inverse(spark, prepared):
    model = encode.fit_one_hot(prepared, ["nom_region"])
    assert model.categories["nom_region"][0] == "Auvergne-Rhône-Alpes"   # code-point order, Î last
    assert model.categories["nom_region"][-1] == "Île-de-France"
    new = spark.createDataFrame([("x", "Bretagne"), ("y", None)], "id_transaction string, nom_region string")
    enc = encode.transform_one_hot(new, model)
    assert all(v == 0 for r in enc.collect() for v in list(r)[1:])
    back = encode.inverse_one_hot(encode.transform_one_hot(prepared, model), "nom_region",
                                  model.categories["nom_region"])
    assert sorted(r["nom_region"] for r in back.collect()) == sorted(prepared_pdf()["nom_region"])
    with pytest.raises(ValueError):
        encode.inverse_one_hot(prepared, "nom_region", model.categories["nom_region"])


def test_encoder_persistence(spark, prepared, tmp_path):
    model = encode.fit_one_hot(prepared, ["type_batiment", "nom_region"])
    model.save(spark, str(tmp_path / "enc"))
    assert encode.OneHotModel.load(spark, str(tmp_path / "enc")).categories == model.categories
