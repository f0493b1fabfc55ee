"""Windows in blocks with halos, against windows over whole groups."""

import random

import pytest
from pyspark.sql import Window, functions as F

from immolytics.operators import features as feat, halo
from immolytics.settings import CITY_KEYS


@pytest.fixture(scope="module")
def cities(spark):
    """One city holds 90 % of the rows; some keys are NULL; some cities have one row."""
    rng, rows = random.Random(6), []
    for name, n in [("long", 1800)] + [(f"c{i}", 1 + i % 20) for i in range(19)] + [(None, 7)]:
        when = rng.sample([(y, m, v) for y in range(1990, 2020) for m in range(1, 13) for v in range(1, 7)], n)
        rows += [("d", name, 1, *w, rng.random() * 1000) for w in when]
    rng.shuffle(rows)
    names = "nom_departement string, ville string, id_ville int, annee_transaction int, mois_transaction int, " \
            "nb_transactions_mois int, prix_m2_moyen double"
    return spark.createDataFrame(rows, names).repartition(7).cache()


def test_places_are_the_ranks(cities):
    got = halo.numbered_in_groups(cities, CITY_KEYS, feat.CITY_ORDER)
    rank = F.row_number().over(feat.city_window()) - 1
    assert got.count() == cities.count()
    assert got.withColumn("want", rank).where("_rank <> want").count() == 0


@pytest.mark.parametrize("block", [6, 7, 100, 100_000])
def test_same_rows_as_whole_cities(cities, block):
    for make in (lambda df, b: feat.previous_month(df, block=b), lambda df, b: feat.rolling_means(df, 6, block=b),
                 lambda df, b: feat.rolling_means(df, 6, exclude_current=True, block=b)):
        want, got = make(cities, None), make(cities, block)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_no_window_partition_beyond_the_block(cities):
    sizes = lambda w: {"in_window": F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))}
    out = halo.in_blocks(cities, CITY_KEYS, feat.CITY_ORDER, 5, sizes, block=50)
    assert out.count() == cities.count() and out.agg(F.max("in_window")).first()[0] == 55


def test_empty_table_and_short_blocks(cities):
    assert feat.rolling_means(cities.limit(0), 3, block=10).count() == 0
    with pytest.raises(ValueError):
        feat.rolling_means(cities, 6, block=4)
