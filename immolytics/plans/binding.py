"""Bind the driver's TPC-H-like tables to the raw property-sales schema.

lineitem -> one sale; orders -> date; customer -> city (market segment within a
nation); nation -> department; region -> region. ``prix_m2_moyen`` and
``nb_transactions_mois`` are raw columns in the real data; here they are derived
per city-month from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.features import feature_engineering
from ..session import materialize
from ..settings import JOIN_KEYS, ROW_KEY
from ..sources.tables import table


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with the raw sales columns and a unique row key."""
    t = lambda name: table(spark, sf_dir, name)
    geo = (t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "n_name", "r_name"))
    # orders x customer first (orders-sized), then a single shuffle of lineitem on orderkey.
    orders = (t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
              .join(t("customer").select("c_custkey", "c_nationkey", "c_mktsegment"),
                    F.col("o_custkey") == F.col("c_custkey"))
              .join(geo, F.col("c_nationkey") == F.col("n_nationkey")))     # broadcast by Parquet size
    li = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    sales = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return sales.select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias(ROW_KEY),
        F.col("l_extendedprice").alias("prix"),
        F.col("c_nationkey").alias("id_ville"),
        F.col("c_mktsegment").alias("ville"),
        F.col("l_returnflag").alias("type_batiment"),
        (F.col("l_linestatus") == "O").cast("int").alias("vefa"),
        F.col("l_linenumber").alias("n_pieces"),
        F.col("l_quantity").alias("surface_habitable"),
        F.col("l_discount").alias("latitude"),
        F.col("l_tax").alias("longitude"),
        F.month("o_orderdate").alias("mois_transaction"),
        F.year("o_orderdate").alias("annee_transaction"),
        F.try_divide("l_extendedprice", "l_quantity").alias("prix_m2"),
        F.col("n_name").alias("nom_departement"),
        F.col("r_name").alias("nom_region"),
    )


def market_months(sales: DataFrame) -> DataFrame:
    """One row per city and month: mean price per m2 and volume."""
    return sales.groupBy(*JOIN_KEYS).agg(
        F.avg("prix_m2").alias("prix_m2_moyen"),
        F.count(F.lit(1)).alias("nb_transactions_mois"),
    )


def with_market_columns(sales: DataFrame, market: DataFrame | None = None) -> DataFrame:
    """Attach the city-month mean price per m2, the month's volume and the below-market flag.

    Aggregated with a partial (map-side) aggregate, then joined back: a hot city
    never lands in one task, and AQE broadcasts the aggregate when it is small.
    """
    out = sales.join(market_months(sales) if market is None else market, JOIN_KEYS, "inner")
    return out.withColumn(
        "en_dessous_du_marche", (F.col("prix_m2") < F.col("prix_m2_moyen")).cast("int"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw sales table (row key + 17 loader columns).

    The market table is written once: by its file Spark sees that it is small, and the sales are not shuffled to meet it.
    """
    sales = raw_transactions(spark, sf_dir)
    return with_market_columns(sales, materialize(market_months(sales), "market"))


def prepared(spark: SparkSession, sf_dir: str, columns: list[str] | None = None, **options) -> DataFrame:
    """The prepared (feature) set with the row key, exact city means (no midway rounding).

    The market table (a row per city and month) is written once: it gives the
    sales their market columns and is itself the city-month table. With ``columns``
    these columns of the sales and the city features are written once too: nothing is joined or ranked
    again where the result is read several times.
    """
    sales = raw_transactions(spark, sf_dir)
    if columns:
        needed = [*JOIN_KEYS, "n_pieces", "prix_m2"]                    # those that the flow groups by and drops
        sales = materialize(sales.select(*dict.fromkeys([*columns, *needed])), "sales")
    market = materialize(market_months(sales), "market")
    return feature_engineering(with_market_columns(sales, market), decimals=None, city_months=market,
                               materialize_city_month=False, materialize_features=bool(columns), **options)


def two_volumes(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Sales whose market columns are taken per city, month and new-build flag: several volumes a month.

    The months of a city then fan its sales out, as in the reference's own data. The sales
    (or some of their ``columns``) are written once for the three passes of the flow, the market
    table too, so that its file shows that it is small.
    """
    sales = raw_transactions(spark, sf_dir)
    sales = materialize(sales.select(*columns) if columns else sales, "sales")
    keys = [*JOIN_KEYS, "vefa"]
    market = materialize(sales.groupBy(*keys).agg(F.avg("prix_m2").alias("prix_m2_moyen"),
                                                  F.count(F.lit(1)).alias("nb_transactions_mois")), "market")
    return (sales.join(market, keys, "inner")
            .withColumn("en_dessous_du_marche", (F.col("prix_m2") < F.col("prix_m2_moyen")).cast("int")))


def with_gaps(df: DataFrame) -> DataFrame:
    """Coordinates equal to 0 are unknown: turn them into NULL (gives the profiles real gaps)."""
    return (df.withColumn("latitude", F.nullif(F.col("latitude"), F.lit(0.0)))
              .withColumn("longitude", F.nullif(F.col("longitude"), F.lit(0.0))))


# Spark type of every column of :func:`transactions` (fixed by the binding).
TRANSACTION_TYPES = {
    "id_transaction": "string", "prix": "double", "id_ville": "int", "ville": "string",
    "type_batiment": "string", "vefa": "int", "n_pieces": "int", "surface_habitable": "double",
    "latitude": "double", "longitude": "double", "mois_transaction": "int",
    "annee_transaction": "int", "prix_m2": "double", "nom_departement": "string",
    "nom_region": "string", "prix_m2_moyen": "double", "nb_transactions_mois": "bigint",
    "en_dessous_du_marche": "int",
}
NUMERIC_COLUMNS = ["prix", "id_ville", "vefa", "n_pieces", "surface_habitable", "latitude",
                   "longitude", "mois_transaction", "annee_transaction", "prix_m2", "prix_m2_moyen",
                   "nb_transactions_mois", "en_dessous_du_marche"]
CATEGORICAL_COLUMNS = ["ville", "type_batiment", "nom_departement", "nom_region"]
CONTINUOUS_COLUMNS = ["prix", "surface_habitable", "latitude", "longitude", "prix_m2", "prix_m2_moyen"]


TRANSACTIONS_SQL = """
WITH sales AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS id_transaction,
         l_extendedprice AS prix, c_nationkey AS id_ville, c_mktsegment AS ville,
         l_returnflag AS type_batiment, CAST(l_linestatus = 'O' AS INTEGER) AS vefa,
         l_linenumber AS n_pieces, l_quantity AS surface_habitable,
         l_discount AS latitude, l_tax AS longitude,
         CAST(month(o_orderdate) AS INTEGER) AS mois_transaction,
         CAST(year(o_orderdate) AS INTEGER) AS annee_transaction,
         l_extendedprice / l_quantity AS prix_m2,
         n_name AS nom_departement, r_name AS nom_region
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
), market AS (
  SELECT nom_departement, ville, id_ville, annee_transaction, mois_transaction,
         avg(prix_m2) AS prix_m2_moyen, count(*) AS nb_transactions_mois
  FROM sales
  GROUP BY nom_departement, ville, id_ville, annee_transaction, mois_transaction
), transactions AS (
  SELECT s.*, m.prix_m2_moyen, m.nb_transactions_mois,
         CAST(s.prix_m2 < m.prix_m2_moyen AS INTEGER) AS en_dessous_du_marche
  FROM sales s
  JOIN market m USING (nom_departement, ville, id_ville, annee_transaction, mois_transaction)
), gaps AS (
  SELECT * REPLACE (NULLIF(latitude, 0.0) AS latitude, NULLIF(longitude, 0.0) AS longitude)
  FROM transactions
)
"""
"""SQL twin of :func:`transactions` (a CTE named ``transactions``) for DuckDB oracles."""
