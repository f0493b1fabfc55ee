"""Registered queries: a Spark plan and, where one exists, its DuckDB SQL twin.

Every query reads the driver's tables (``sf_dir``) through the binding of
``plans.binding`` and runs over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import features as feat
from ..session import materialize
from ..settings import JOIN_KEYS, LINE_KEY, ROW_KEY
from .binding import TRANSACTIONS_SQL, market_months, prepared, raw_transactions, transactions, two_volumes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --------------------------------------------------------------------------
# Shared SQL fragments (DuckDB dialect)
# --------------------------------------------------------------------------
CITY_MONTH_SQL = TRANSACTIONS_SQL + """
, cm0 AS (
  SELECT nom_departement, ville, id_ville, annee_transaction, mois_transaction, nb_transactions_mois,
         avg(prix_m2_moyen) AS prix_m2_moyen
  FROM transactions
  WHERE nom_departement IS NOT NULL AND ville IS NOT NULL AND id_ville IS NOT NULL
    AND annee_transaction IS NOT NULL AND mois_transaction IS NOT NULL AND nb_transactions_mois IS NOT NULL
  GROUP BY nom_departement, ville, id_ville, annee_transaction, mois_transaction, nb_transactions_mois
), cm1 AS (
  SELECT *, sum(nb_transactions_mois) OVER (PARTITION BY nom_departement, annee_transaction, mois_transaction)
            ::BIGINT AS nb_transactions_departement
  FROM cm0
), cm2 AS (
  SELECT *, nb_transactions_mois / nb_transactions_departement * 100 AS ratio_transaction FROM cm1
), cm3 AS (
  SELECT *, CASE WHEN ratio_transaction > (SELECT quantile_cont(ratio_transaction, 0.8) FROM cm2)
                 THEN 1 ELSE 0 END AS ville_demandee
  FROM cm2
), city_month AS (
  SELECT *,
         lag(prix_m2_moyen) OVER w AS prix_m2_moyen_mois_precedent,
         lag(nb_transactions_mois) OVER w AS nb_transactions_mois_precedent
  FROM cm3
  WINDOW w AS (PARTITION BY nom_departement, ville, id_ville
               ORDER BY annee_transaction, mois_transaction, nb_transactions_mois)
)
"""

PREPARED_SQL = CITY_MONTH_SQL + """
, feats AS (
  SELECT nom_departement, ville, id_ville, annee_transaction, mois_transaction,
         prix_m2_moyen_mois_precedent, nb_transactions_mois_precedent, ville_demandee
  FROM city_month
  WHERE prix_m2_moyen_mois_precedent IS NOT NULL AND nb_transactions_mois_precedent IS NOT NULL
), prepared AS (
  SELECT t.id_transaction, t.prix, t.type_batiment, t.vefa, t.surface_habitable, t.latitude, t.longitude,
         t.mois_transaction, t.annee_transaction, t.en_dessous_du_marche, t.nom_region,
         f.prix_m2_moyen_mois_precedent, f.nb_transactions_mois_precedent, f.ville_demandee
  FROM transactions t
  JOIN feats f USING (nom_departement, ville, id_ville, annee_transaction, mois_transaction)
)
"""


def prepared_table(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """The prepared set (or some of its columns) written once, for flows that read it several times."""
    rows = prepared(spark, sf_dir)
    return materialize(rows.select(*columns) if columns else rows, "prepared")


def city_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City-month rows with the market features; the binding's market table has one row per city and month."""
    cm = materialize(feat.city_month(market_months(raw_transactions(spark, sf_dir)), decimals=None), "city-month")
    return feat.previous_month(feat.compute_city_features(cm, grouped=True))


# --------------------------------------------------------------------------
# Sources, binding, features
# --------------------------------------------------------------------------
@register("transactions", TRANSACTIONS_SQL + "SELECT * FROM transactions")
def q_transactions(spark, sf_dir):
    from ..operators.columns import keep_known_columns
    return keep_known_columns(transactions(spark, sf_dir), extra=[ROW_KEY])


@register("city_month", CITY_MONTH_SQL + "SELECT * FROM city_month")
def q_city_month(spark, sf_dir):
    return city_months(spark, sf_dir)


@register("prepared_features", PREPARED_SQL + "SELECT * FROM prepared")
def q_prepared_features(spark, sf_dir):
    return prepared(spark, sf_dir)


# --------------------------------------------------------------------------
# Profile statistics (A5-A17, R1-R2) on the raw sales table
# --------------------------------------------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from . import sqlgen  # noqa: E402
from ..operators import stats  # noqa: E402
from ..operators.correlation import wide_correlation  # noqa: E402
from .binding import (CATEGORICAL_COLUMNS, CONTINUOUS_COLUMNS, NUMERIC_COLUMNS,  # noqa: E402
                      TRANSACTION_TYPES, with_gaps)


def _wrap(body: str, base: str = TRANSACTIONS_SQL) -> str:
    return base + f"SELECT * FROM ({body})"


@register("null_profile", _wrap(sqlgen.null_profile("gaps", TRANSACTION_TYPES)))
def q_null_profile(spark, sf_dir):
    df = with_gaps(transactions(spark, sf_dir)).select(*TRANSACTION_TYPES)
    return stats.null_profile(df)


@register("value_counts", _wrap(sqlgen.value_counts("transactions", CATEGORICAL_COLUMNS)))
def q_value_counts(spark, sf_dir):
    return stats.value_counts(transactions(spark, sf_dir), CATEGORICAL_COLUMNS)


@register("describe_numeric", _wrap(sqlgen.describe_numeric("gaps", NUMERIC_COLUMNS)))
def q_describe_numeric(spark, sf_dir):
    return stats.describe_numeric(with_gaps(transactions(spark, sf_dir)), NUMERIC_COLUMNS)


@register("describe_categorical", _wrap(sqlgen.describe_categorical("transactions", CATEGORICAL_COLUMNS)))
def q_describe_categorical(spark, sf_dir):
    return stats.describe_categorical(transactions(spark, sf_dir), CATEGORICAL_COLUMNS)


@register("correlation_matrix", _wrap(sqlgen.correlation("gaps", NUMERIC_COLUMNS)))
def q_correlation_matrix(spark, sf_dir):
    return stats.correlation_matrix(with_gaps(transactions(spark, sf_dir)), NUMERIC_COLUMNS)


_LIT = "CASE WHEN n_pieces < 7 THEN surface_habitable * 0.9 + n_pieces END"      # goes with the surface, has gaps


@register("strong_pairs", TRANSACTIONS_SQL + f""", lit AS (
  SELECT *, {_LIT} AS surface_eclairee, -prix_m2 AS remise FROM transactions)
SELECT * FROM ({sqlgen.correlation("lit", NUMERIC_COLUMNS + ["surface_eclairee", "remise"], "abs(r) > 0.7")})""")
def q_strong_pairs(spark, sf_dir):
    tx = transactions(spark, sf_dir).withColumn("surface_eclairee", F.expr(_LIT)).withColumn("remise", -F.col("prix_m2"))
    return stats.strong_pairs(stats.correlation_matrix(tx, NUMERIC_COLUMNS + ["surface_eclairee", "remise"]), 0.7)


# A component per column: as many as the vectors have, in pairs of blocks.
@register("embedding_correlation", """
WITH cells AS (SELECT vec_id, unnest(embedding)::DOUBLE AS value, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)
SELECT 'e' || a.pos AS col_a, 'e' || b.pos AS col_b,
       covar_pop(a.value, b.value) / NULLIF(stddev_pop(a.value) * stddev_pop(b.value), 0) AS r
FROM cells a JOIN cells b ON a.vec_id = b.vec_id AND a.pos < b.pos GROUP BY a.pos, b.pos""")
def q_embedding_correlation(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("embedding")
    width = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    components = vectors.select(*[F.get("embedding", F.lit(i)).alias(f"e{i}") for i in range(width)])
    return wide_correlation(components, block=32)


@register("crosstab", TRANSACTIONS_SQL + """
SELECT type_batiment, CAST(count_if(en_dessous_du_marche = 0) AS BIGINT) AS n_0,
       CAST(count_if(en_dessous_du_marche = 1) AS BIGINT) AS n_1
FROM transactions GROUP BY type_batiment""")
def q_crosstab(spark, sf_dir):
    return stats.crosstab(transactions(spark, sf_dir), "type_batiment", "en_dessous_du_marche", [0, 1])


@register("count_by", TRANSACTIONS_SQL + """
SELECT nom_region, en_dessous_du_marche, count(*) AS n FROM transactions GROUP BY ALL""")
def q_count_by(spark, sf_dir):
    return stats.count_by(transactions(spark, sf_dir), "nom_region", "en_dessous_du_marche")


@register("histogram", _wrap(sqlgen.histogram("gaps", CONTINUOUS_COLUMNS, 20)))
def q_histogram(spark, sf_dir):
    """Extents and bins read the narrow columns, written once, instead of the binding's joins each."""
    narrow = materialize(with_gaps(transactions(spark, sf_dir)).select(*CONTINUOUS_COLUMNS), "continuous")
    return stats.histogram(narrow, CONTINUOUS_COLUMNS, 20)


@register("conditional_distribution",
          _wrap(sqlgen.histogram("transactions", CONTINUOUS_COLUMNS, 20, by="en_dessous_du_marche")))
def q_conditional_distribution(spark, sf_dir):
    narrow = materialize(transactions(spark, sf_dir).select("en_dessous_du_marche", *CONTINUOUS_COLUMNS), "continuous")
    return stats.histogram(narrow, CONTINUOUS_COLUMNS, 20, by="en_dessous_du_marche")


@register("boxplot_stats", _wrap(sqlgen.boxplot("transactions", ["prix", "surface_habitable", "prix_m2"],
                                                "type_batiment")))
def q_boxplot_stats(spark, sf_dir):
    return stats.boxplot_stats(transactions(spark, sf_dir), ["prix", "surface_habitable", "prix_m2"],
                               by="type_batiment")


@register("kde", _wrap(sqlgen.kde("transactions", ["prix_m2", "surface_habitable"])))
def q_kde(spark, sf_dir):
    return stats.kde(transactions(spark, sf_dir), ["prix_m2", "surface_habitable"])


@register("grid_counts", _wrap(sqlgen.grid_counts("transactions", "surface_habitable", "prix", 20)))
def q_grid_counts(spark, sf_dir):
    return stats.grid_counts(transactions(spark, sf_dir), "surface_habitable", "prix", 20)


PAIR_COLUMNS = ["surface_habitable", "prix", "latitude", "longitude", "n_pieces"]


@register("pair_grid", _wrap(sqlgen.pair_grid("gaps", PAIR_COLUMNS, 20)))
def q_pair_grid(spark, sf_dir):
    """A17 for all pairs: the narrow projection is written once, the sources are scanned once."""
    rows = with_gaps(transactions(spark, sf_dir)).select(*PAIR_COLUMNS)
    return stats.pair_grid(materialize(rows, "pairs"), PAIR_COLUMNS, 20)


@register("distinct_values", TRANSACTIONS_SQL + "SELECT DISTINCT nom_region FROM transactions")
def q_distinct_values(spark, sf_dir):
    return stats.distinct_values(transactions(spark, sf_dir), "nom_region")


# --------------------------------------------------------------------------
# Splits (E1, E2, E7, E8, T5, T6, J3)
# --------------------------------------------------------------------------
from ..operators import splits  # noqa: E402
from ..sources.tables import table  # noqa: E402

EVENTS_RN = """
WITH ev AS (
  SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rn, count(*) OVER () AS n FROM events
)
"""


@register("train_test_split", PREPARED_SQL + """
SELECT id_transaction,
       CASE WHEN row_number() OVER (ORDER BY md5(concat_ws('|', '42', id_transaction)), id_transaction)
                 <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
FROM prepared""")
def q_train_test_split(spark, sf_dir):
    return splits.with_split(prepared_table(spark, sf_dir, [ROW_KEY]), [ROW_KEY])


FANOUT_SQL = TRANSACTIONS_SQL + """
, market2 AS (
  SELECT nom_departement, ville, id_ville, annee_transaction, mois_transaction, vefa,
         avg(prix_m2) AS prix_m2_moyen, count(*) AS nb_transactions_mois
  FROM sales GROUP BY ALL
), cm0 AS (
  SELECT nom_departement, ville, id_ville, annee_transaction, mois_transaction, nb_transactions_mois,
         avg(prix_m2_moyen) AS prix_m2_moyen
  FROM (SELECT m.* FROM sales JOIN market2 m USING (nom_departement, ville, id_ville, annee_transaction, mois_transaction, vefa))
  GROUP BY ALL
), cm1 AS (
  SELECT *, lag(nb_transactions_mois) OVER (PARTITION BY nom_departement, ville, id_ville
            ORDER BY annee_transaction, mois_transaction, nb_transactions_mois) AS nb_precedent
  FROM cm0
), fan AS (
  SELECT concat_ws('#', id_transaction, f.nb_transactions_mois) AS id_ligne, nb_precedent
  FROM sales JOIN (SELECT * FROM cm1 WHERE nb_precedent IS NOT NULL) f
       USING (nom_departement, ville, id_ville, annee_transaction, mois_transaction)
)
"""


@register("fanout_split", FANOUT_SQL + """
SELECT id_ligne, nb_precedent AS nb_transactions_mois_precedent,
       CASE WHEN row_number() OVER (ORDER BY md5(concat_ws('|', '42', id_ligne)), id_ligne)
                 <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
FROM fan""")
def q_fanout_split(spark, sf_dir):
    sales = two_volumes(spark, sf_dir, [ROW_KEY, *JOIN_KEYS, "vefa", "n_pieces", "prix_m2"])
    rows = feat.feature_engineering(sales, decimals=None, line_key_of=ROW_KEY)
    lines = materialize(rows.select(LINE_KEY, "nb_transactions_mois_precedent"), "lines")
    return splits.with_split(lines, [LINE_KEY])


@register("sample_reference", PREPARED_SQL + """
SELECT id_transaction,
       CASE WHEN row_number() OVER (ORDER BY md5(concat_ws('|', '42-reference', id_transaction)), id_transaction)
                 <= round_even(0.8 * count(*) OVER (), 0) THEN 'reference' ELSE 'current' END AS dataset
FROM prepared""")
def q_sample_reference(spark, sf_dir):
    return splits.sample_reference(prepared_table(spark, sf_dir, [ROW_KEY]), [ROW_KEY])


@register("time_series_folds", EVENTS_RN + """
SELECT event_id, CAST(CASE WHEN rn <= n - 5 * (n // 6) THEN 0
                           ELSE (rn - (n - 5 * (n // 6)) - 1) // (n // 6) + 1 END AS INTEGER) AS block
FROM ev""")
def q_time_series_folds(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return splits.time_series_blocks(ev, ["ts", "event_id"]).select("event_id", "block")


@register("k_folds", EVENTS_RN + """
SELECT event_id, CAST(CASE WHEN rn <= (n % 5) * (n // 5 + 1) THEN (rn - 1) // (n // 5 + 1)
                           ELSE (n % 5) + (rn - 1 - (n % 5) * (n // 5 + 1)) // (n // 5) END AS INTEGER) AS fold
FROM ev""")
def q_k_folds(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return splits.k_folds(ev, ["ts", "event_id"]).select("event_id", "fold")


@register("temporal_split", EVENTS_RN + """
SELECT event_id, CASE WHEN rn <= floor(0.8 * n) THEN 'reference' ELSE 'current' END AS dataset FROM ev""")
def q_temporal_split(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return splits.temporal_split(ev, ["ts", "event_id"]).select("event_id", "dataset")


@register("positional_halves", """
SELECT event_id, CASE WHEN row_number() OVER (ORDER BY event_id) <= count(*) OVER () // 2
                      THEN 'reference' ELSE 'current' END AS dataset FROM events""")
def q_positional_halves(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return splits.positional_halves(ev, ["event_id"]).select("event_id", "dataset")


@register("balanced_folds", TRANSACTIONS_SQL + """
, g AS (SELECT id_ville, ville, count(*) AS n, md5(concat_ws('|', coalesce(id_ville::VARCHAR, ''), coalesce(ville, ''))) AS h
        FROM transactions GROUP BY ALL)
, p AS (SELECT id_ville, ville, row_number() OVER (ORDER BY n DESC, h) - 1 AS place FROM g)
SELECT t.id_transaction, CAST(CASE WHEN (place // 5) % 2 = 0 THEN place % 5 ELSE 4 - place % 5 END AS INTEGER) AS fold
FROM transactions t JOIN p ON t.id_ville IS NOT DISTINCT FROM p.id_ville AND t.ville IS NOT DISTINCT FROM p.ville""")
def q_balanced_folds(spark, sf_dir):
    """Whole cities dealt to five folds of about equal size."""
    return splits.balanced_folds(transactions(spark, sf_dir), ["id_ville", "ville"], 5).select(ROW_KEY, "fold")


# --------------------------------------------------------------------------
# Encoding (E3-E6) and evaluation of a fixed scorer
# --------------------------------------------------------------------------
from ..operators import categories, encode, halo, metrics  # noqa: E402
from ..settings import COLS_TO_ENCODE  # noqa: E402

SPLIT_SQL = PREPARED_SQL + """
, split AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY md5(concat_ws('|', '42', id_transaction)), id_transaction)
                      <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
  FROM prepared
), scored AS (
  SELECT *, prix_m2_moyen_mois_precedent * surface_habitable AS prediction FROM split
), test AS (SELECT * FROM scored WHERE split = 'test')
, cats AS (
  SELECT 'type_batiment' AS col, type_batiment AS cat FROM split WHERE split = 'train' AND type_batiment IS NOT NULL
  UNION SELECT 'nom_region', nom_region FROM split WHERE split = 'train' AND nom_region IS NOT NULL
), ranked_cats AS (SELECT *, row_number() OVER (PARTITION BY col ORDER BY cat) AS pos FROM cats)
"""


def market_prediction():
    """Fixed scorer with an SQL twin: last month's city price per m2 times the surface."""
    return F.col("prix_m2_moyen_mois_precedent") * F.col("surface_habitable")


def split_prepared(spark, sf_dir, columns=None):
    return splits.with_split(prepared_table(spark, sf_dir, columns), [ROW_KEY])


# What the fixed scorer and its errors need: the only columns that are written for them.
SCORED = [ROW_KEY, "prix", "prix_m2_moyen_mois_precedent", "surface_habitable"]


def scored_market(spark, sf_dir, columns=None):
    return split_prepared(spark, sf_dir, columns).withColumn("prediction", market_prediction())


@register("split_and_encode", SPLIT_SQL + """
SELECT s.id_transaction, s.split, k.col || '_' || k.cat AS feature,
       CAST(coalesce((CASE k.col WHEN 'type_batiment' THEN s.type_batiment ELSE s.nom_region END) = k.cat, FALSE)
            AS INTEGER) AS value
FROM split s, ranked_cats k WHERE k.pos > 1""")
def q_split_and_encode(spark, sf_dir):
    s = split_prepared(spark, sf_dir, [ROW_KEY, *COLS_TO_ENCODE])
    model = encode.fit_one_hot(s.where(F.col("split") == "train"), COLS_TO_ENCODE)
    enc = encode.transform_one_hot(s, model)
    return enc.unpivot([ROW_KEY, "split"], model.all_feature_names, "feature", "value")


@register("inverse_one_hot", SPLIT_SQL + """
SELECT id_transaction,
  CASE WHEN type_batiment IN (SELECT cat FROM ranked_cats WHERE col = 'type_batiment') THEN type_batiment
       ELSE (SELECT cat FROM ranked_cats WHERE col = 'type_batiment' AND pos = 1) END AS type_batiment,
  CASE WHEN nom_region IN (SELECT cat FROM ranked_cats WHERE col = 'nom_region') THEN nom_region
       ELSE (SELECT cat FROM ranked_cats WHERE col = 'nom_region' AND pos = 1) END AS nom_region
FROM split""")
def q_inverse_one_hot(spark, sf_dir):
    s = split_prepared(spark, sf_dir, [ROW_KEY, *COLS_TO_ENCODE])
    model = encode.fit_one_hot(s.where(F.col("split") == "train"), COLS_TO_ENCODE)
    out = encode.transform_one_hot(s.select(ROW_KEY, *COLS_TO_ENCODE), model)
    for c in COLS_TO_ENCODE:
        out = encode.inverse_one_hot(out, c, model.categories[c])
    return out.select(ROW_KEY, *COLS_TO_ENCODE)


# The part of the sales that the categories are learned from, and the sales to encode.
PARTS_SQL = """
WITH sold AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS id_transaction, l_linestatus = 'F' AS learned,
         l_returnflag AS flag, CAST(l_partkey AS VARCHAR) AS part, CAST(l_suppkey AS VARCHAR) AS supplier
  FROM lineitem
), cells AS (
  SELECT id_transaction, learned, 1 AS place, 'flag' AS column_name, flag AS category FROM sold
  UNION ALL SELECT id_transaction, learned, 2, 'part', part FROM sold
  UNION ALL SELECT id_transaction, learned, 3, 'supplier', supplier FROM sold
), cats AS (
  SELECT place, column_name, category, row_number() OVER (PARTITION BY column_name ORDER BY category) - 1 AS position
  FROM (SELECT DISTINCT place, column_name, category FROM cells WHERE learned AND category IS NOT NULL)
), numbered AS (
  SELECT column_name, category, position,
         CASE WHEN position > 0 THEN CAST(count_if(position > 0) OVER (ORDER BY place, category) - 1 AS INTEGER) END AS feature
  FROM cats
)
"""


def sold_parts(spark, sf_dir):
    from ..sources.tables import table
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias(ROW_KEY),
        F.col("l_linestatus").alias("status"), F.col("l_returnflag").alias("flag"),
        F.col("l_partkey").cast("string").alias("part"), F.col("l_suppkey").cast("string").alias("supplier"))


def part_categories(rows):
    return categories.fit_categories(rows.where(F.col("status") == "F"), ["flag", "part", "supplier"])


@register("category_table", PARTS_SQL + "SELECT column_name, category, CAST(position AS BIGINT) AS position, feature FROM numbered")
def q_category_table(spark, sf_dir):
    """E3 with any number of categories: a dictionary of flags, parts and suppliers."""
    return part_categories(sold_parts(spark, sf_dir)).table


@register("sparse_encoding", PARTS_SQL + """
SELECT id_transaction, CAST(count(n.feature) AS INTEGER) AS n_active, CAST(coalesce(sum(n.feature), 0) AS BIGINT) AS feature_sum,
       max(n.feature) AS last_feature
FROM cells c LEFT JOIN numbered n USING (column_name, category) GROUP BY id_transaction""")
def q_sparse_encoding(spark, sf_dir):
    """E4 with any number of categories: the sparse indicators of every sale."""
    rows = sold_parts(spark, sf_dir)
    out = categories.transform_sparse(rows, part_categories(rows))
    at = F.col("indicators.indices")
    return out.select(ROW_KEY, F.size(at).alias("n_active"),
                      F.aggregate(at, F.lit(0).cast("long"), lambda s, x: s + x).alias("feature_sum"),
                      F.try_element_at(at, F.lit(-1)).alias("last_feature"))


@register("sparse_inverse", PARTS_SQL + """
SELECT c.id_transaction, coalesce(n.category, d.category) AS part
FROM cells c LEFT JOIN (SELECT * FROM numbered WHERE feature IS NOT NULL) n USING (column_name, category)
CROSS JOIN (SELECT category FROM numbered WHERE column_name = 'part' AND position = 0) d
WHERE c.column_name = 'part'""")
def q_sparse_inverse(spark, sf_dir):
    """E6 through the category table: parts rebuilt from the sparse indicators."""
    rows = sold_parts(spark, sf_dir)
    known = part_categories(rows)
    return categories.inverse_sparse(categories.transform_sparse(rows, known), known, "part").select(ROW_KEY, "part")


_MSE = "avg((prix - prediction) * (prix - prediction))"
_R2 = "1.0 - sum((prix - prediction) * (prix - prediction)) / (var_pop(prix) * count(*))"
_METRICS_SQL = f"count(*) AS n, {_MSE} AS mse, sqrt({_MSE}) AS rmse, avg(abs(prix - prediction)) AS mae, {_R2} AS r2"
_ABS_SQL = ("count(*) AS count, avg(abs(prix - prediction)) AS mean, stddev_samp(abs(prix - prediction)) AS std, "
            "min(abs(prix - prediction)) AS min, quantile_cont(abs(prix - prediction), 0.25) AS p25, "
            "quantile_cont(abs(prix - prediction), 0.5) AS p50, quantile_cont(abs(prix - prediction), 0.75) AS p75, "
            "max(abs(prix - prediction)) AS max")


@register("regression_metrics", SPLIT_SQL + f"SELECT split, {_METRICS_SQL} FROM scored GROUP BY split")
def q_regression_metrics(spark, sf_dir):
    return metrics.regression_metrics(scored_market(spark, sf_dir, SCORED), by=["split"])


@register("abs_error_stats", SPLIT_SQL + f"SELECT split, {_ABS_SQL} FROM scored GROUP BY split")
def q_abs_error_stats(spark, sf_dir):
    return metrics.abs_error_stats(scored_market(spark, sf_dir, SCORED), by=["split"])


@register("residual_range", SPLIT_SQL + """
SELECT avg(prix - prediction) AS mean, stddev_pop(prix - prediction) AS std,
       avg(prix - prediction) - 4 * stddev_pop(prix - prediction) AS low,
       avg(prix - prediction) + 4 * stddev_pop(prix - prediction) AS high
FROM test""")
def q_residual_range(spark, sf_dir):
    return metrics.residual_range(scored_market(spark, sf_dir, SCORED).where(F.col("split") == "test"))


@register("extreme_errors", SPLIT_SQL + """
SELECT * FROM (SELECT 'largest' AS which, id_transaction, prix, prediction, surface_habitable, nom_region FROM test
               ORDER BY prix - prediction DESC, id_transaction DESC LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'smallest', id_transaction, prix, prediction, surface_habitable, nom_region FROM test
               ORDER BY prix - prediction ASC, id_transaction ASC LIMIT 1)""")
def q_extreme_errors(spark, sf_dir):
    test = scored_market(spark, sf_dir).where(F.col("split") == "test")
    return metrics.extreme_errors(test, ROW_KEY, ["prix", "prediction", "surface_habitable", "nom_region"])


_CATS = ["type_batiment", "nom_region", "vefa", "ville_demandee"]


@register("error_by_category", SPLIT_SQL + """
, lv AS (
  SELECT prix - prediction AS e, prix AS y, category_column, category FROM (
    SELECT prix, prediction, CAST(type_batiment AS VARCHAR) AS type_batiment, CAST(nom_region AS VARCHAR) AS nom_region,
           CAST(vefa AS VARCHAR) AS vefa, CAST(ville_demandee AS VARCHAR) AS ville_demandee FROM test)
  UNPIVOT (category FOR category_column IN (type_batiment, nom_region, vefa, ville_demandee)))
SELECT category_column, category, count(*) AS n, avg(e) AS mean_error, avg(abs(e)) AS mae,
       sqrt(avg(e * e)) AS rmse, 1.0 - sum(e * e) / NULLIF(var_pop(y) * count(*), 0) AS r2,
       quantile_cont(e, 0.25) AS q1, quantile_cont(e, 0.5) AS median, quantile_cont(e, 0.75) AS q3
FROM lv GROUP BY category_column, category""")
def q_error_by_category(spark, sf_dir):
    test = scored_market(spark, sf_dir).where(F.col("split") == "test")
    return metrics.error_by_category(test, _CATS)


@register("mean_baseline", SPLIT_SQL + f"""
, mb AS (SELECT prix, (SELECT avg(prix) FROM split WHERE split = 'train') AS prediction FROM split WHERE split = 'test')
SELECT {_METRICS_SQL} FROM mb""")
def q_mean_baseline(spark, sf_dir):
    s = split_prepared(spark, sf_dir)
    test = metrics.with_mean_baseline(s.where(F.col("split") == "train"), s.where(F.col("split") == "test"))
    return metrics.regression_metrics(test)


@register("evaluate", SPLIT_SQL + f"""
SELECT split, {_METRICS_SQL}, avg(abs(prix - prediction)) AS error_mean, stddev_samp(abs(prix - prediction)) AS error_std
FROM scored GROUP BY split""")
def q_evaluate(spark, sf_dir):
    return metrics.evaluate(scored_market(spark, sf_dir, SCORED))


MODEL_DRIFT_SQL = SPLIT_SQL + f"""
, halves AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY id_transaction) <= count(*) OVER () // 2
                 THEN 'reference' ELSE 'current' END AS dataset FROM test
), m AS (SELECT dataset, {_MSE} AS mse, sqrt({_MSE}) AS rmse, avg(abs(prix - prediction)) AS mae, {_R2} AS r2
         FROM halves GROUP BY dataset)
, long AS (SELECT dataset, metric, value FROM m UNPIVOT (value FOR metric IN (mse, rmse, mae, r2)))
, wide AS (SELECT metric, max(CASE WHEN dataset = 'reference' THEN value END) AS reference_value,
                  max(CASE WHEN dataset = 'current' THEN value END) AS current_value FROM long GROUP BY metric)
, report AS (
  SELECT metric, reference_value, current_value,
         CASE WHEN reference_value <> 0 THEN abs(current_value - reference_value) / abs(reference_value)
              ELSE abs(current_value - reference_value) END AS relative_diff
  FROM wide)
"""


def model_drift_report(spark, sf_dir):
    test = scored_market(spark, sf_dir, SCORED).where(F.col("split") == "test")
    return metrics.model_drift(splits.positional_halves(test, [ROW_KEY]))


@register("model_drift", MODEL_DRIFT_SQL + "SELECT *, relative_diff > 0.1 AS has_drift FROM report")
def q_model_drift(spark, sf_dir):
    return model_drift_report(spark, sf_dir)


@register("drift_table", MODEL_DRIFT_SQL + """
SELECT metric AS "Metric", reference_value AS "Reference", current_value AS "Current",
       relative_diff * 100 AS "Drift (%)" FROM report""")
def q_drift_table(spark, sf_dir):
    return metrics.drift_table(model_drift_report(spark, sf_dir))


# --------------------------------------------------------------------------
# Data drift (M5, M6, T3) between the reference sample and the rest
# --------------------------------------------------------------------------
from ..operators import drift, drift_state  # noqa: E402
from ..session import scratch_path  # noqa: E402

DRIFT_NUMERIC = ["prix", "surface_habitable", "latitude", "longitude", "mois_transaction",
                 "annee_transaction", "prix_m2_moyen_mois_precedent", "nb_transactions_mois_precedent"]
DRIFT_CATEGORICAL = ["type_batiment", "nom_region", "vefa", "en_dessous_du_marche", "ville_demandee"]

DRIFT_SQL = PREPARED_SQL + """
, dr AS (
  SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42-reference', id_transaction)), id_transaction)
            <= round_even(0.8 * count(*) OVER (), 0) AS is_ref
  FROM prepared
)
"""


# The current rows as they would be after a change of market: dearer, larger, later, of one type.
SHIFTED = {"prix": "prix * 1.5", "surface_habitable": "surface_habitable + 10", "annee_transaction": "annee_transaction + 1",
           "prix_m2_moyen_mois_precedent": "prix_m2_moyen_mois_precedent * 1.2", "latitude": "latitude + 0.05",
           "nb_transactions_mois_precedent": "nb_transactions_mois_precedent + 5", "type_batiment": "'N'"}


def drift_report(spark, sf_dir, shifted: bool = False):
    rows = prepared_table(spark, sf_dir, [ROW_KEY, *DRIFT_NUMERIC, *DRIFT_CATEGORICAL])
    s = splits.sample_reference(rows, [ROW_KEY]).withColumn(drift.REF, F.col("dataset") == "reference")
    if shifted:
        s = s.withColumns({c: F.when(F.col(drift.REF), F.col(c)).otherwise(F.expr(e)) for c, e in SHIFTED.items()})
    return drift.drift_of(s, DRIFT_NUMERIC, DRIFT_CATEGORICAL, threshold=0.05)


_DRIFT_BODY = sqlgen.data_drift("dr", "is_ref", DRIFT_NUMERIC, DRIFT_CATEGORICAL, 0.05)
_SHIFTED_BODY = sqlgen.data_drift("shifted", "is_ref", DRIFT_NUMERIC, DRIFT_CATEGORICAL, 0.05)
SHIFTED_SQL = DRIFT_SQL + ", shifted AS (SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN is_ref THEN {c} ELSE {e} END AS {c}" for c, e in SHIFTED.items()) + ") FROM dr)"


@register("data_drift", DRIFT_SQL + f"SELECT * FROM ({_DRIFT_BODY})")
def q_data_drift(spark, sf_dir):
    return drift_report(spark, sf_dir)


@register("incremental_drift", PREPARED_SQL + ", years AS (SELECT *, annee_transaction < 1998 AS is_old FROM prepared) "
          + f"SELECT * FROM ({sqlgen.data_drift('years', 'is_old', DRIFT_NUMERIC, DRIFT_CATEGORICAL, 0.05)})")
def q_incremental_drift(spark, sf_dir):
    """M5: the newest year against all earlier ones, from the stored counts of two batches."""
    rows = prepared_table(spark, sf_dir, [*DRIFT_NUMERIC, *DRIFT_CATEGORICAL])
    state, year = drift_state.DriftState(spark, scratch_path(spark, "drift-state")), F.col("annee_transaction")
    state.add("old", rows.where(year < 1998), year, DRIFT_NUMERIC, DRIFT_CATEGORICAL)
    state.add("new", rows.where(year >= 1998), year, DRIFT_NUMERIC, DRIFT_CATEGORICAL)
    return state.drift(F.col("period") < "1998", F.col("period") >= "1998")


@register("drift_summary", SHIFTED_SQL + f"""
SELECT count(*) AS total_features, CAST(count_if(drifted) AS BIGINT) AS drifted_features,
       count_if(drifted) / count(*) AS drift_share, count_if(drifted) / count(*) >= 0.5 AS dataset_drift,
       count_if(drifted) / count(*) >= 0.5 AND count_if(drifted) / count(*) > 0.2 AS stop
FROM ({_SHIFTED_BODY})""")
def q_drift_summary(spark, sf_dir):
    return drift.dataset_drift(drift_report(spark, sf_dir, shifted=True)).drop("timestamp")


@register("top_drifted", SHIFTED_SQL + f"""
SELECT * FROM ({_SHIFTED_BODY}) ORDER BY score DESC, column_name LIMIT 5""")
def q_top_drifted(spark, sf_dir):
    return drift.top_drifted(drift_report(spark, sf_dir, shifted=True), 5)


# --------------------------------------------------------------------------
# Scalar and text functions (F1-F3), rolling windows (W3, W4), row slices
# --------------------------------------------------------------------------
from ..functions import scalar as fscalar, text as ftext  # noqa: E402
from ..operators import columns as cols  # noqa: E402

_WS = ftext.whitespace_class()
_ALLOWED = ", ".join("'" + r.replace("'", "''") + "'" for r in ftext.allowed_regions())


@register("normalize_text", f"""
SELECT doc_id, trim(regexp_replace(strip_accents(lower(text)), '{_WS}', ' ', 'g')) AS normalized
FROM documents""")
def q_normalize_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", ftext.normalize_text("text").alias("normalized"))


# Region names as users type them, for some of the binding's regions.
_TYPED = "CASE r_name WHEN 'EUROPE' THEN 'Île-de-France' WHEN 'ASIA' THEN '  OCCITANIE ' WHEN 'AFRICA' THEN 'Bretagne' ELSE r_name END"


@register("allowed_region", f"""
SELECT n_name, r_name,
       trim(regexp_replace(strip_accents(lower({_TYPED})), '{_WS}', ' ', 'g')) AS region_normalized,
       trim(regexp_replace(strip_accents(lower({_TYPED})), '{_WS}', ' ', 'g')) IN ({_ALLOWED}) AS allowed
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def q_allowed_region(spark, sf_dir):
    geo = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"),
                                              F.col("n_regionkey") == F.col("r_regionkey"))
    return geo.withColumn("typed", F.expr(_TYPED)).select(
        "n_name", "r_name", ftext.normalize_text("typed").alias("region_normalized"), ftext.allowed_region("typed").alias("allowed"))


@register("rounded_prices", TRANSACTIONS_SQL + """
SELECT id_transaction, round_even(prix_m2 * 100, 0) / 100 AS prix_m2_arrondi FROM transactions""")
def q_rounded_prices(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    return tx.select(ROW_KEY, fscalar.round_half_even("prix_m2", 2).alias("prix_m2_arrondi"))


@register("rolling_means", CITY_MONTH_SQL + """
, roll AS (
  SELECT *,
         CASE WHEN count(*) OVER w6 = 6 THEN avg(prix_m2_moyen) OVER w6 END AS prix_m2_moyen_glissant_6m,
         CASE WHEN count(*) OVER w6 = 6 THEN avg(nb_transactions_mois) OVER w6 END AS nb_transaction_moyen_glissant_6m
  FROM city_month
  WINDOW w6 AS (PARTITION BY nom_departement, ville, id_ville
                ORDER BY annee_transaction, mois_transaction, nb_transactions_mois
                ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)
)
SELECT * FROM roll WHERE prix_m2_moyen_mois_precedent IS NOT NULL AND nb_transactions_mois_precedent IS NOT NULL
  AND prix_m2_moyen_glissant_6m IS NOT NULL AND nb_transaction_moyen_glissant_6m IS NOT NULL""")
def q_rolling_means(spark, sf_dir):
    return cols.drop_incomplete(feat.rolling_means(city_months(spark, sf_dir), 6))


@register("region_last_sales", TRANSACTIONS_SQL + """
SELECT id_transaction, lag(prix) OVER w AS prix_precedent,
       CASE WHEN count(*) OVER w6 = 6 THEN avg(surface_habitable) OVER w6 END AS surface_moyenne_6
FROM transactions
WINDOW w AS (PARTITION BY nom_region ORDER BY annee_transaction, mois_transaction, id_transaction),
       w6 AS (PARTITION BY nom_region ORDER BY annee_transaction, mois_transaction, id_transaction
              ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""")
def q_region_last_sales(spark, sf_dir):
    """W1-W4 over few, very long groups: each region's sales in blocks with halos."""
    order = ["annee_transaction", "mois_transaction", ROW_KEY]

    def last_rows(w):
        frame = w.rowsBetween(-5, 0)
        return {"prix_precedent": F.lag("prix").over(w),
                "surface_moyenne_6": F.when(F.count(F.lit(1)).over(frame) == 6, F.avg("surface_habitable").over(frame))}

    sales = raw_transactions(spark, sf_dir).select("nom_region", *order, "prix", "surface_habitable")
    out = halo.in_blocks(sales, ["nom_region"], order, 5, last_rows, block=4096)
    return out.select(ROW_KEY, "prix_precedent", "surface_moyenne_6")


@register("below_market_rows", TRANSACTIONS_SQL + """
SELECT id_transaction, prix, prix_m2, prix_m2_moyen FROM transactions WHERE en_dessous_du_marche = 1""")
def q_below_market_rows(spark, sf_dir):
    tx = cols.slice_by_value(transactions(spark, sf_dir), "en_dessous_du_marche", 1)
    return tx.select(ROW_KEY, "prix", "prix_m2", "prix_m2_moyen")


@register("complete_rows", TRANSACTIONS_SQL + """
SELECT id_transaction, latitude, longitude FROM gaps WHERE latitude IS NOT NULL AND longitude IS NOT NULL""")
def q_complete_rows(spark, sf_dir):
    tx = with_gaps(transactions(spark, sf_dir)).select(ROW_KEY, "latitude", "longitude")
    return cols.drop_incomplete(tx)


# --------------------------------------------------------------------------
# File sources and sinks (S1-S7): write the sales table, read it back by extension
# --------------------------------------------------------------------------
from ..session import scratch_path  # noqa: E402
from ..settings import LOADED_COLUMNS  # noqa: E402
from ..sources import files  # noqa: E402

_LOADED_SQL = TRANSACTIONS_SQL + "SELECT id_transaction, " + ", ".join(LOADED_COLUMNS) + " FROM transactions"


def _roundtrip(spark, sf_dir, ext: str, writer, **read_kwargs):
    tx = cols.keep_known_columns(transactions(spark, sf_dir), extra=[ROW_KEY])
    path = scratch_path(spark, "roundtrip") + ext
    writer(tx, path)
    return files.load_table(spark, path, extra=[ROW_KEY], schema=tx.schema, **read_kwargs)


@register("csv_roundtrip", _LOADED_SQL)
def q_csv_roundtrip(spark, sf_dir):
    return _roundtrip(spark, sf_dir, ".csv", files.write_delimited)


@register("txt_roundtrip", _LOADED_SQL)
def q_txt_roundtrip(spark, sf_dir):
    return _roundtrip(spark, sf_dir, ".txt", files.write_delimited)


@register("json_roundtrip", _LOADED_SQL)
def q_json_roundtrip(spark, sf_dir):
    return _roundtrip(spark, sf_dir, ".json", files.write_json)


@register("json_array", _LOADED_SQL)
def q_json_array(spark, sf_dir):
    return _roundtrip(spark, sf_dir, ".json", files.write_json_array)


@register("parquet_columns", TRANSACTIONS_SQL + """
SELECT id_transaction, prix, surface_habitable, nom_region FROM transactions""")
def q_parquet_columns(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    path = files.write_parquet(tx, scratch_path(spark, "sales") + ".parquet")
    return files.read_file(spark, path, columns=[ROW_KEY, "prix", "surface_habitable", "nom_region"])


# --------------------------------------------------------------------------
# Model: cross-validation (M2), scoring rows (M11, P8), attributions (M9, M10, T4), GBT (M1, M3, M4)
# --------------------------------------------------------------------------
from ..operators import attribution, model as pm, tree_attribution  # noqa: E402

BASE_FEATURES = ["vefa", "surface_habitable", "latitude", "longitude", "mois_transaction", "annee_transaction",
                 "prix_m2_moyen_mois_precedent", "nb_transactions_mois_precedent", "ville_demandee"]
# Categories of the binding's encoded columns (TPC-H return flags and region names), for the twin of scoring_rows.
INDICATORS = {"type_batiment": ["N", "R"], "nom_region": ["AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]}


def encoded_split(spark, sf_dir):
    s = split_prepared(spark, sf_dir)
    enc = encode.fit_one_hot(s.where(F.col("split") == "train"), COLS_TO_ENCODE)
    return encode.transform_one_hot(s, enc), enc


def encoded_rows(spark, sf_dir, *keep: str):
    """``encoded_split`` for flows that read it many times: the sales are joined once, the rows with their split
    (the columns ``keep``, the price and the features) are written once."""
    rows = prepared(spark, sf_dir, [ROW_KEY, "prix", "vefa", "surface_habitable", "latitude", "longitude", *COLS_TO_ENCODE])
    s = splits.with_split(rows, [ROW_KEY]).select(*keep, "split", "prix", *BASE_FEATURES, *COLS_TO_ENCODE)
    s = materialize(s, "split-rows")
    enc = encode.fit_one_hot(s.where(F.col("split") == "train"), COLS_TO_ENCODE)
    return encode.transform_one_hot(s, enc), enc


@register("cv_mean_baseline", PREPARED_SQL + f"""
, ob AS (SELECT prix, row_number() OVER (ORDER BY annee_transaction, mois_transaction, id_transaction) AS rn,
                count(*) OVER () AS n FROM prepared)
, blk AS (SELECT prix, CASE WHEN rn <= n - 5 * (n // 6) THEN 0 ELSE (rn - (n - 5 * (n // 6)) - 1) // (n // 6) + 1 END AS block
          FROM ob)
, f AS (SELECT i AS fold, prix, CASE WHEN block < i THEN 'train' ELSE 'test' END AS role
        FROM blk, range(1, 6) t(i) WHERE block <= i)
, p AS (SELECT *, avg(CASE WHEN role = 'train' THEN prix END) OVER (PARTITION BY fold) AS prediction FROM f)
, m AS (SELECT fold, role, sqrt({_MSE}) AS rmse, avg(abs(prix - prediction)) AS mae, {_R2} AS r2
        FROM p GROUP BY fold, role)
, l AS (SELECT fold, role, metric, score FROM (
          SELECT fold, role, -rmse AS neg_root_mean_squared_error, -mae AS neg_mean_absolute_error, r2 FROM m)
        UNPIVOT (score FOR metric IN (neg_root_mean_squared_error, neg_mean_absolute_error, r2)))
SELECT metric,
       avg(CASE WHEN role = 'train' THEN score END) AS moyenne_train,
       stddev_pop(CASE WHEN role = 'train' THEN score END) AS ecart_type_train,
       avg(CASE WHEN role = 'test' THEN score END) AS moyenne_test,
       stddev_pop(CASE WHEN role = 'test' THEN score END) AS ecart_type_test
FROM l GROUP BY metric""")
def q_cv_mean_baseline(spark, sf_dir):
    order = ["annee_transaction", "mois_transaction", ROW_KEY]
    blocks = splits.time_series_blocks(prepared_table(spark, sf_dir, [*order, "prix"]), order, 5)
    return pm.cross_validate(blocks, pm.mean_fitter(), 5)


@register("cv_gbt", PREPARED_SQL + """
, n AS (SELECT count(*) AS n FROM prepared)
SELECT CAST(i AS INTEGER) AS fold, n // 6 AS n_test, n - (6 - i) * (n // 6) AS n_train, TRUE AS beats_mean
FROM n, range(1, 6) t(i)""")
def q_cv_gbt(spark, sf_dir):
    """M2 with the boosted trees, all 150 of them: expanding folds of one written feature table, fitted five at a time.

    The sales are written once, so orders and line items are joined once; the folds' table holds no row keys.

    The label is the price per m2, on which the surface bears; in these tables the
    price itself depends on none of the features, so no fit beats its mean.
    """
    order, label = ["annee_transaction", "mois_transaction", ROW_KEY], "prix_m2"
    rows = prepared(spark, sf_dir, [ROW_KEY, "prix", "vefa", "surface_habitable", "latitude", "longitude"])
    blocks = materialize(splits.time_series_blocks(rows, order, 5)
                         .select(*BASE_FEATURES, F.try_divide("prix", "surface_habitable").alias(label), "block"), "blocks")
    trees = pm.fold_metrics(blocks, pm.gbt_fitter(BASE_FEATURES, label), 5, label=label, parallelism=5)
    mean = (pm.fold_metrics(blocks, pm.mean_fitter(label), 5, label=label)
            .where("role = 'test'").select("fold", F.col("rmse").alias("mean_rmse")))
    by_role = trees.groupBy("fold").agg(*[F.max(F.when(F.col("role") == r, F.col("n"))).alias(f"n_{r}") for r in ("test", "train")],
                                        F.max(F.when(F.col("role") == "test", F.col("rmse"))).alias("rmse"))
    return by_role.join(mean, "fold").select("fold", "n_test", "n_train", (F.col("rmse") < F.col("mean_rmse")).alias("beats_mean"))


@register("cv_kfold_mean", PREPARED_SQL + f"""
, ob AS (SELECT prix, row_number() OVER (ORDER BY annee_transaction, mois_transaction, id_transaction) - 1 AS rn,
                count(*) OVER () AS n FROM prepared)
, blk AS (SELECT prix, CASE WHEN rn < (n % 5) * (n // 5 + 1) THEN rn // (n // 5 + 1)
                            ELSE (n % 5) + (rn - (n % 5) * (n // 5 + 1)) // (n // 5) END AS fold_no FROM ob)
, f AS (SELECT i AS fold, prix, CASE WHEN fold_no = i THEN 'test' ELSE 'train' END AS role FROM blk, range(0, 5) t(i))
, p AS (SELECT *, avg(CASE WHEN role = 'train' THEN prix END) OVER (PARTITION BY fold) AS prediction FROM f)
, m AS (SELECT fold, role, sqrt({_MSE}) AS rmse, avg(abs(prix - prediction)) AS mae, {_R2} AS r2
        FROM p GROUP BY fold, role)
, l AS (SELECT fold, role, metric, score FROM (
          SELECT fold, role, -rmse AS neg_root_mean_squared_error, -mae AS neg_mean_absolute_error, r2 FROM m)
        UNPIVOT (score FOR metric IN (neg_root_mean_squared_error, neg_mean_absolute_error, r2)))
SELECT metric,
       avg(CASE WHEN role = 'train' THEN score END) AS moyenne_train,
       stddev_pop(CASE WHEN role = 'train' THEN score END) AS ecart_type_train,
       avg(CASE WHEN role = 'test' THEN score END) AS moyenne_test,
       stddev_pop(CASE WHEN role = 'test' THEN score END) AS ecart_type_test
FROM l GROUP BY metric""")
def q_cv_kfold_mean(spark, sf_dir):
    order = ["annee_transaction", "mois_transaction", ROW_KEY]
    folds = splits.k_folds(prepared_table(spark, sf_dir, [*order, "prix"]), order, 5)
    return pm.cross_validate(folds, pm.mean_fitter(), 5, kind="k")


_IND_SQL = ", ".join(f"CAST(coalesce({c} = '{v}', FALSE) AS INTEGER) AS \"{c}_{v}\""
                     for c, vs in INDICATORS.items() for v in vs)


@register("scoring_rows", SPLIT_SQL + f"""
SELECT id_transaction, {', '.join(BASE_FEATURES)}, {_IND_SQL} FROM test""")
def q_scoring_rows(spark, sf_dir):
    s = split_prepared(spark, sf_dir)
    enc = encode.fit_one_hot(s.where(F.col("split") == "train"), COLS_TO_ENCODE)
    # Requests as a form would send them: region already normalised (lower case, no accents).
    requests = (s.where(F.col("split") == "test")
                 .withColumn("nom_region", ftext.normalize_text("nom_region")))
    return pm.build_scoring_rows(requests, enc, [ROW_KEY] + BASE_FEATURES + enc.all_feature_names)


MARKET_TERMS = [(1.0, ("prix_m2_moyen_mois_precedent", "surface_habitable"))]


def market_attributions(spark, sf_dir, wide: bool = False):
    """Exact attributions of the market scorer, a product of two columns, over the whole training set."""
    enc_s, enc = encoded_split(spark, sf_dir)
    train, test = enc_s.where(F.col("split") == "train"), enc_s.where(F.col("split") == "test")
    return tree_attribution.product_attribution(test, train, MARKET_TERMS, BASE_FEATURES + enc.all_feature_names, ROW_KEY, wide)


_BASE_LIST = ", ".join("'" + f + "'" for f in BASE_FEATURES)
SHAP_SQL = SPLIT_SQL + f"""
, means AS (
  SELECT avg(prix_m2_moyen_mois_precedent) AS ma, avg(surface_habitable) AS mb,
         avg(prix_m2_moyen_mois_precedent * surface_habitable) AS mab
  FROM split WHERE split = 'train'
), phi2 AS (
  SELECT id_transaction, ((a * mb - mab) + (a * b - ma * b)) / 2 AS phi_a, ((ma * b - mab) + (a * b - a * mb)) / 2 AS phi_b
  FROM (SELECT id_transaction, prix_m2_moyen_mois_precedent AS a, surface_habitable AS b FROM test), means
), feature_names AS (
  SELECT unnest([{_BASE_LIST}]) AS feature UNION ALL SELECT col || '_' || cat FROM ranked_cats WHERE pos > 1)
, phi AS (
  SELECT id_transaction, feature,
         CASE feature WHEN 'prix_m2_moyen_mois_precedent' THEN phi_a WHEN 'surface_habitable' THEN phi_b ELSE 0.0 END AS phi
  FROM phi2, feature_names)
"""

THREE_WAY = ["prix_m2_moyen_mois_precedent", "surface_habitable", "latitude"]


@register("shapley_three_way", SPLIT_SQL + """
, m AS (
  SELECT avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(a * b) AS mab, avg(a * c) AS mac, avg(b * c) AS mbc, avg(a * b * c) AS mabc
  FROM (SELECT prix_m2_moyen_mois_precedent AS a, surface_habitable AS b, 1 + latitude AS c FROM split WHERE split = 'train')
), t3 AS (SELECT id_transaction, prix_m2_moyen_mois_precedent AS a, surface_habitable AS b, 1 + latitude AS c FROM test)
, phi3 AS (
  SELECT id_transaction,
         w2 * (a * mbc - mabc) + w1 * (b * a * mc - b * mac) + w1 * (c * a * mb - c * mab) + w2 * (b * c * a - b * c * ma)
           AS prix_m2_moyen_mois_precedent,
         w2 * (b * mac - mabc) + w1 * (a * b * mc - a * mbc) + w1 * (c * b * ma - c * mab) + w2 * (a * c * b - a * c * mb)
           AS surface_habitable,
         w2 * (c * mab - mabc) + w1 * (a * c * mb - a * mbc) + w1 * (b * c * ma - b * mac) + w2 * (a * b * c - a * b * mc)
           AS latitude
  FROM t3, m, (SELECT 2::DOUBLE / 6 AS w2, 1::DOUBLE / 6 AS w1))
SELECT id_transaction, feature, round(phi, 3) AS phi FROM phi3
UNPIVOT (phi FOR feature IN (prix_m2_moyen_mois_precedent, surface_habitable, latitude))""")
def q_shapley_three_way(spark, sf_dir):
    """A scorer with a term of three features: a * b * (1 + c)."""
    s = split_prepared(spark, sf_dir).withColumn("latitude", 1 + F.col("latitude"))
    phi = tree_attribution.product_attribution(s.where("split = 'test'"), s.where("split = 'train'"), [(1.0, tuple(THREE_WAY))],
                                               THREE_WAY, ROW_KEY)
    return phi.withColumn("phi", F.round("phi", 3))              # differences of large terms: the last digits follow the summing order


# A model of three trees, written down so that SQL can state it too: (tree, id, feature, threshold, left, right, value).
TREE_FEATURES = ["surface_habitable", "mois_transaction", "prix_m2_moyen_mois_precedent", "ville_demandee"]
TREES = [(0, 0, 0, 25.0, 1, 2, 0.0), (0, 1, 1, 6.0, 3, 4, 0.0), (0, 2, 2, 1500.0, 5, 6, 0.0), (0, 3, -1, 0.0, -1, -1, 10.0),
         (0, 4, -1, 0.0, -1, -1, 20.0), (0, 5, -1, 0.0, -1, -1, 35.0), (0, 6, 3, 0.5, 7, 8, 0.0), (0, 7, -1, 0.0, -1, -1, 50.0),
         (0, 8, -1, 0.0, -1, -1, 80.0),
         (1, 0, 0, 10.0, 1, 2, 0.0), (1, 1, -1, 0.0, -1, -1, 5.0), (1, 2, 0, 40.0, 3, 4, 0.0), (1, 3, 3, 0.5, 5, 6, 0.0),
         (1, 4, -1, 0.0, -1, -1, 12.0), (1, 5, -1, 0.0, -1, -1, 1.0), (1, 6, -1, 0.0, -1, -1, 7.0),
         (2, 0, -1, 0.0, -1, -1, 100.0)]
# The same leaves as intervals (lowest excluded, highest included) of the features on their paths.
_LEAVES = [(0, 10, [(0, None, 25), (1, None, 6)]), (1, 20, [(0, None, 25), (1, 6, None)]), (2, 35, [(0, 25, None), (2, None, 1500)]),
           (3, 50, [(0, 25, None), (2, 1500, None), (3, None, 0.5)]), (4, 80, [(0, 25, None), (2, 1500, None), (3, 0.5, None)]),
           (5, 5, [(0, None, 10)]), (6, 12, [(0, 40, None)]), (7, 1, [(0, 10, 40), (3, None, 0.5)]), (8, 7, [(0, 10, 40), (3, 0.5, None)])]
_PATHS = ", ".join(f"({leaf}, {value}, '{TREE_FEATURES[f]}', {1 << k}, {1e300 if hi is None else hi}, {-1e300 if lo is None else lo})"
                   for leaf, value, path in _LEAVES for k, (f, lo, hi) in enumerate(path))
TREE_SQL = SPLIT_SQL + f"""
, paths AS (SELECT * FROM (VALUES {_PATHS}) v(leaf, value, feature, bit, hi, lo)
), sizes AS (SELECT leaf, sum(bit) AS full_mask FROM paths GROUP BY leaf
), long AS (
  SELECT id_transaction, split, feature, v FROM (SELECT id_transaction, split, {', '.join(f'{f}::DOUBLE AS {f}' for f in TREE_FEATURES)} FROM split)
  UNPIVOT INCLUDE NULLS (v FOR feature IN ({', '.join(TREE_FEATURES)}))
), patterns AS (
  SELECT id_transaction, split, leaf, sum(CASE WHEN v > lo AND v <= hi THEN bit ELSE 0 END)::BIGINT AS pattern
  FROM long JOIN paths USING (feature) GROUP BY ALL
), z AS (SELECT leaf, pattern AS z, count(*) AS n FROM patterns WHERE split = 'train' GROUP BY ALL
), x AS (SELECT DISTINCT leaf, pattern AS x FROM patterns WHERE split = 'test'
), met AS (
  SELECT leaf, x, z, n, bit_count(x & ~z) AS u, bit_count(z & ~x) AS w FROM x JOIN z USING (leaf) JOIN sizes USING (leaf)
  WHERE (x | z) = full_mask AND x <> z
), gains AS (
  SELECT leaf, x, feature, sum(CASE WHEN x & bit <> 0 AND z & bit = 0 THEN value * n * factorial(u::INT - 1) * factorial(w::INT) / factorial((u + w)::INT)
                                    WHEN z & bit <> 0 AND x & bit = 0 THEN -value * n * factorial(u::INT) * factorial(w::INT - 1) / factorial((u + w)::INT)
                                    ELSE 0 END) / (SELECT count(*) FROM split WHERE split = 'train') AS phi
  FROM met JOIN paths USING (leaf) GROUP BY ALL
), tree_phi AS (
  SELECT p.id_transaction, feature, sum(phi) AS phi FROM patterns p JOIN gains g ON g.leaf = p.leaf AND g.x = p.pattern
  WHERE split = 'test' GROUP BY ALL
)
"""


@register("tree_attribution", TREE_SQL + """
SELECT t.id_transaction, f.feature, coalesce(phi, 0) AS phi
FROM test t CROSS JOIN (SELECT DISTINCT feature FROM paths) f LEFT JOIN tree_phi USING (id_transaction, feature)""")
def q_tree_attribution(spark, sf_dir):
    """M9: exact attributions of trees over the whole training set."""
    s = materialize(split_prepared(spark, sf_dir).select(ROW_KEY, "split", *TREE_FEATURES), "tree-rows")
    return tree_attribution.tree_attribution(s.where("split = 'test'"), s.where("split = 'train'"), TREES, TREE_FEATURES, ROW_KEY)


@register("gbt_attribution", SPLIT_SQL + "SELECT count(*) AS n, TRUE AS adds_up FROM test")
def q_gbt_attribution(spark, sf_dir):
    """M9 of fitted gradient-boosted trees: each row's phis and the training mean add up to its prediction."""
    enc_s, enc = encoded_rows(spark, sf_dir, ROW_KEY)
    features = BASE_FEATURES + enc.all_feature_names
    train, test = enc_s.where("split = 'train'"), enc_s.where("split = 'test'")
    model = pm.train_price_model(train, features, maxIter=10)
    nodes = tree_attribution.tree_nodes(spark, model)
    start = tree_attribution.expected_value(train, nodes, features)
    phi = tree_attribution.tree_attribution(test, train, nodes, features, ROW_KEY)
    total = phi.groupBy(ROW_KEY).agg(F.sum("phi").alias("total"))
    gap = F.abs(F.col("total") + start - F.col("prediction"))
    scored = pm.score(model, test).select(ROW_KEY, "prediction")
    return scored.join(total, ROW_KEY, "left").agg(F.count(F.lit(1)).alias("n"), F.coalesce(
        F.bool_and(F.coalesce(gap < 1e-6 * F.abs("prediction"), F.lit(False))), F.lit(True)).alias("adds_up"))


@register("shapley_attribution", SHAP_SQL + "SELECT * FROM phi")
def q_shapley_attribution(spark, sf_dir):
    return market_attributions(spark, sf_dir)


@register("global_importance", SHAP_SQL + "SELECT feature, avg(abs(phi)) AS mean_abs_phi FROM phi GROUP BY feature")
def q_global_importance(spark, sf_dir):
    return attribution.global_importance(market_attributions(spark, sf_dir))


@register("top_attributions", SHAP_SQL + """
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY id_transaction ORDER BY abs(phi) DESC, feature)
                             AS INTEGER) AS rank
               FROM phi) WHERE rank <= 6""")
def q_top_attributions(spark, sf_dir):
    return attribution.top_attributions(market_attributions(spark, sf_dir, wide=True), ROW_KEY, 6, wide=True)


@register("price_model", SPLIT_SQL + """
SELECT split, count(*) AS n, 0::BIGINT AS n_null_predictions, TRUE AS sound FROM split GROUP BY split""")
def q_price_model(spark, sf_dir):
    """M1 + M3: gradient boosting with the reference hyper-parameters.

    States what holds for any sound fit: every row is scored, the RMSE on the
    training rows is below that of their mean, and the RMSE on the test rows is at
    most a twentieth above it (the synthetic prices do not depend on the features).
    """
    enc_s, enc = encoded_rows(spark, sf_dir)
    train = enc_s.where(F.col("split") == "train")
    model = pm.train_price_model(train, BASE_FEATURES + enc.all_feature_names)
    scored = pm.score(model, enc_s).withColumn("_mean", train.select(F.avg("prix")).scalar())
    e, m = F.col("prix") - F.col("prediction"), F.col("prix") - F.col("_mean")
    return scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction").isNull() | F.isnan("prediction")).alias("n_null_predictions"),
        (F.sqrt(F.avg(e * e)) < F.sqrt(F.avg(m * m)) * F.when(F.first("split") == "train", 1.0).otherwise(1.05)).alias("sound"))


# --------------------------------------------------------------------------
# Column kinds (P7, P9), price per m2 (P10), run log (S9, S10), snapshot (S8), encoder store
# --------------------------------------------------------------------------
from ..sources.runlog import RunLog, latest_parent_run, latest_run  # noqa: E402
from ..sources.snapshot import reference_and_current  # noqa: E402


@register("column_kinds", TRANSACTIONS_SQL + "SELECT column_name, CASE WHEN n > 2 THEN 'continuous' ELSE 'discrete' END AS kind "
          "FROM (SELECT " + ", ".join(f"count(DISTINCT {c}) AS {c}" for c in NUMERIC_COLUMNS)
          + f" FROM transactions) UNPIVOT (n FOR column_name IN ({', '.join(NUMERIC_COLUMNS)})) UNION ALL SELECT * FROM (VALUES "
          + ", ".join(f"('{c}', 'categorical')" for c in [ROW_KEY, *CATEGORICAL_COLUMNS]) + ") t(column_name, kind)")
def q_column_kinds(spark, sf_dir):
    tx = materialize(transactions(spark, sf_dir), "sales")
    continuous = set(cols.continuous_columns(tx))
    rows = [(c, "continuous" if c in continuous else "discrete") for c in cols.numeric_columns(tx)]
    rows += [(c, "categorical") for c in cols.categorical_columns(tx)]
    return spark.createDataFrame(rows, "column_name string, kind string")


_FEATURES = ["type_batiment", "vefa", "surface_habitable", "latitude", "longitude", "mois_transaction", "annee_transaction",
             "nom_region", "prix_m2_moyen_mois_precedent", "nb_transactions_mois_precedent", "ville_demandee"]


@register("feature_values", PREPARED_SQL + "SELECT column_name AS feature, n FROM (SELECT "
          + ", ".join(f"count({c}) AS {c}" for c in _FEATURES)
          + f" FROM prepared) UNPIVOT (n FOR column_name IN ({', '.join(_FEATURES)}))")
def q_feature_values(spark, sf_dir):
    """The feature columns (no targets, no key) of the prepared set, with their number of values."""
    rows = prepared(spark, sf_dir)
    features = cols.feature_columns(rows, keys=(ROW_KEY,))
    return rows.agg(*[F.count(c).alias(c) for c in features]).unpivot([], features, "feature", "n")


@register("predicted_price_per_m2", SPLIT_SQL + """
SELECT id_transaction, CASE WHEN surface_habitable <> 0 THEN prediction / surface_habitable END AS prix_m2_predit FROM scored""")
def q_predicted_price_per_m2(spark, sf_dir):
    rows = prepared(spark, sf_dir).withColumn("prediction", market_prediction())
    return rows.select(ROW_KEY, cols.price_per_m2().alias("prix_m2_predit"))


@register("run_log", TRANSACTIONS_SQL + "SELECT 'count_' || type_batiment AS key, CAST(count(*) AS DOUBLE) AS value "
          "FROM transactions GROUP BY type_batiment UNION ALL SELECT 'total', count(*) FROM transactions")
def q_run_log(spark, sf_dir):
    """Metrics logged from a frame and as values, read back by run."""
    log = RunLog(spark, scratch_path(spark, "runs"))
    counts = materialize(stats.count_by(transactions(spark, sf_dir), "type_batiment"), "counts")
    run, other = log.start_run("training_a", {"Run_Type": "model_training"}), log.start_run("training_b")
    log.log_metrics_frame(run, counts.select(F.concat(F.lit("count_"), "type_batiment").alias("key"), "n"), "key", "n")
    log.log_metrics(run, {"total": counts.agg(F.sum("n")).first()[0]})
    log.log_metrics(other, {"total": -1})
    return log.table("metrics").where(F.col("run_id") == run).select("key", "value")


@register("latest_run", TRANSACTIONS_SQL + """
SELECT 'tag' AS look_up, 'run_b' AS run_name, CAST(count(*) AS DOUBLE) AS total FROM transactions WHERE vefa = 1
UNION ALL SELECT 'name', 'training_c', CAST(count(*) AS DOUBLE) FROM transactions""")
def q_latest_run(spark, sf_dir):
    """The newest tagged run and the newest run of a name, which differ, with their metric."""
    log = RunLog(spark, scratch_path(spark, "runs"))
    counts = {r["vefa"]: r["n"] for r in stats.count_by(transactions(spark, sf_dir), "vefa").collect()}
    tag = {"Run_Type": "model_training"}
    for name, tags, total in (("training_a", tag, counts.get(0, 0)), ("run_b", tag, counts.get(1, 0)),
                              ("training_c", {}, sum(counts.values())), ("data_drift_check", {"Run_Type": "data_drift"}, 0)):
        log.log_metrics(log.start_run(name, tags), {"total": total})
    runs, metric = log.table("runs"), log.table("metrics").where("key = 'total'").select("run_id", F.col("value").alias("total"))
    found = (latest_run(runs, log.table("tags")).withColumn("look_up", F.lit("tag"))
             .unionByName(latest_parent_run(runs).withColumn("look_up", F.lit("name"))))
    return found.join(metric, "run_id").select("look_up", "run_name", "total")


@register("reference_snapshot", PREPARED_SQL + """
SELECT id_transaction, CASE WHEN row_number() OVER (ORDER BY md5(concat_ws('|', '42-reference', id_transaction)), id_transaction)
                                 <= round_even(0.8 * count(*) OVER (), 0) THEN 'reference' ELSE 'current' END AS dataset
FROM prepared""")
def q_reference_snapshot(spark, sf_dir):
    """The first call stores the reference; the second reads it back."""
    rows = prepared_table(spark, sf_dir, [ROW_KEY])
    path = scratch_path(spark, "reference") + ".parquet"
    _, current = reference_and_current(spark, rows, path, [ROW_KEY])
    reference, everything = reference_and_current(spark, rows, path, [ROW_KEY])
    rest = splits.complement(everything, reference, [ROW_KEY])
    both = rest.join(current, ROW_KEY)                       # the rest is what the first call compared
    return (reference.select(ROW_KEY, F.lit("reference").alias("dataset"))
            .unionByName(both.select(ROW_KEY, F.lit("current").alias("dataset"))))


@register("encoder_roundtrip", SPLIT_SQL + """
SELECT k.col || '_' || k.cat AS feature,
       CAST(sum(coalesce((CASE k.col WHEN 'type_batiment' THEN s.type_batiment ELSE s.nom_region END) = k.cat, FALSE)::INT) AS BIGINT) AS n
FROM split s, ranked_cats k WHERE k.pos > 1 GROUP BY ALL""")
def q_encoder_roundtrip(spark, sf_dir):
    """An encoder stored and loaded again encodes all rows."""
    s = split_prepared(spark, sf_dir)
    path = scratch_path(spark, "encoder")
    encode.fit_one_hot(s.where(F.col("split") == "train"), COLS_TO_ENCODE).save(spark, path)
    model = encode.OneHotModel.load(spark, path)
    names = model.all_feature_names
    return (encode.transform_one_hot(s.select(*COLS_TO_ENCODE), model)
            .agg(*[F.sum(F.col(c)).alias(c) for c in names]).unpivot([], names, "feature", "n"))


# --------------------------------------------------------------------------
# Display helpers: head (T2) and the total of missing values (A5)
# --------------------------------------------------------------------------
@register("head_rows", TRANSACTIONS_SQL + """
SELECT id_transaction, prix, ville, nom_region FROM transactions ORDER BY prix DESC, id_transaction LIMIT 5""")
def q_head_rows(spark, sf_dir):
    tx = transactions(spark, sf_dir).select(ROW_KEY, "prix", "ville", "nom_region")
    return stats.top_values(tx, "prix", 5, ROW_KEY)


@register("total_nulls", TRANSACTIONS_SQL + "SELECT CAST(" + " + ".join(
    f"count_if({c} IS NULL{' OR isnan(' + c + ')' if t == 'double' else ''})" for c, t in TRANSACTION_TYPES.items())
    + " AS BIGINT) AS total_null FROM gaps")
def q_total_nulls(spark, sf_dir):
    df = with_gaps(transactions(spark, sf_dir)).select(*TRANSACTION_TYPES)
    return stats.total_nulls(stats.null_profile(df))
