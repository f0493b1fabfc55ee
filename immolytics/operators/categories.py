"""One-hot encoding through a category table, for any number of categories.

``encode`` makes a column per category and keeps the categories in the driver.
Here the dictionary is a table (column, category, position, feature) that is
numbered, stored and joined by Spark, and a row's indicators are one sparse
vector: the driver holds one number per encoded column. The rules are the same:
categories in code-point order, the first one dropped, NULL and unknown values
all zeros.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..session import materialize
from .columns import require_columns
from .stats import long_values

# Dictionaries of at most so many rows or bytes are broadcast; larger ones are joined on salted keys.
MOST_BROADCAST = 100_000
MOST_BROADCAST_BYTES = 10 << 20
SALTS = 16


@dataclass
class CategoryTable:
    """``table``: column_name, category, position (0: dropped), feature (index in the vector, NULL if dropped)."""
    table: DataFrame
    sizes: dict[str, int]                                  # categories per encoded column, in order
    lengths: dict[str, int] = field(default_factory=dict, compare=False)       # bytes of a column's categories, where known

    @property
    def columns(self) -> list[str]:
        return list(self.sizes)

    @property
    def n_features(self) -> int:
        return sum(max(0, n - 1) for n in self.sizes.values())

    def save(self, path: str) -> None:
        """The dictionary as parquet; the columns' order is kept in a column of its own."""
        at = F.create_map(*[F.lit(x) for i, c in enumerate(self.sizes) for x in (c, i)])
        self.table.withColumn("column_at", at[F.col("column_name")]).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, columns: list[str] | None = None) -> CategoryTable:
        """``columns`` names encoded columns that had no category, which leave no row in the table."""
        table = spark.read.parquet(path)
        rows = table.groupBy("column_at", "column_name").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("category")).alias("bytes")) \
                    .orderBy("column_at").collect()                            # a row per column
        found = {r["column_name"]: r["n"] for r in rows}
        return cls(table.drop("column_at"), {c: found.get(c, 0) for c in columns or found}, {r["column_name"]: r["bytes"] for r in rows})


def fit_categories(df: DataFrame, columns: list[str]) -> CategoryTable:
    """Distinct non-null categories of every column, numbered by code point.

    The distinct categories are range-partitioned by (column, category) and written
    with the number of their slice; a category's position is its rank within the
    slice plus the sizes of the slices before, so no task sorts a whole column.
    """
    require_columns(df, columns)
    if not columns:
        raise ValueError("no columns to encode")
    distinct = long_values(df, columns, cast="string", value="category").where(F.col("category").isNotNull()).distinct()
    sliced = materialize(distinct.repartitionByRange("column_name", "category")
                         .withColumn("slice", F.spark_partition_id()), "categories")
    counts = sliced.groupBy("column_name", "slice").agg(F.count(F.lit(1)).alias("n"),      # columns + slices rows
                                                        F.sum(F.octet_length("category")).alias("bytes"))
    before = Window.partitionBy("column_name").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("column_name", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    found = {r["column_name"]: r for r in counts.groupBy("column_name").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).collect()}
    sizes = {c: found[c]["n"] if c in found else 0 for c in columns}

    first, at = [], 0                                      # where a column's features begin
    for c, n in sizes.items():
        first += [F.lit(c), F.lit(at)]
        at += max(0, n - 1)
    within = F.row_number().over(Window.partitionBy("column_name", "slice").orderBy("category"))
    table = (sliced.withColumn("within", within).join(F.broadcast(offsets), ["column_name", "slice"])
             .withColumn("position", (F.col("offset") + F.col("within") - 1).cast("long")))
    feature = F.when(F.col("position") > 0, F.create_map(*first)[F.col("column_name")] + F.col("position") - 1)
    table = table.select("column_name", "category", "position", feature.cast("int").alias("feature"))
    return CategoryTable(materialize(table, "category-table"), sizes, {c: r["bytes"] for c, r in found.items()})


def _looked_up(df: DataFrame, key: Column, side: DataFrame, categories: CategoryTable, column: str, salt: Column) -> DataFrame:
    """Left join of ``df`` with ``side`` (``_k`` and a value of the categories of ``column``): broadcast if small, else salted.

    The salted side asks for a merge join: Spark would judge it by the dictionary's file, before
    the salts multiply its rows, and gather them all in the driver for a broadcast.
    """
    keyed, rows = df.withColumn("_key", key), categories.sizes[column]
    size = 32 * rows + categories.lengths.get(column, MOST_BROADCAST_BYTES)          # 32: the fixed part of a row of two fields
    may = not df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")
    if rows <= MOST_BROADCAST or may and size <= MOST_BROADCAST_BYTES:
        return keyed.join(F.broadcast(side), F.col("_key") == F.col("_k"), "left").drop("_key", "_k")
    spread = side.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
    return (keyed.withColumn("_s", salt)
            .join(spread, (F.col("_key") == F.col("_k")) & (F.col("_s") == F.col("_t")), "left")
            .drop("_key", "_k", "_s", "_t"))


def _salt(df: DataFrame) -> Column:
    """A number per row from its own values (the same whenever a task is run again)."""
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.StringType, T.DateType,
                                                                         T.TimestampType, T.BooleanType))]
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]), F.lit(SALTS)).cast("int")


def transform_sparse(df: DataFrame, categories: CategoryTable, output: str = "indicators") -> DataFrame:
    """``df`` without the encoded columns, and ``output``: struct of size, indices, values (ones).

    One look-up join per encoded column; the indices come out sorted.
    """
    require_columns(df, categories.columns)
    salt, out = _salt(df), df
    for i, c in enumerate(categories.sizes):
        side = categories.table.where((F.col("column_name") == c) & F.col("feature").isNotNull()) \
                               .select(F.col("category").alias("_k"), F.col("feature").alias(f"_f{i}"))
        out = _looked_up(out, F.col(c).cast("string"), side, categories, c, salt)
    indices = F.array_compact(F.array(*[F.col(f"_f{i}") for i in range(len(categories.sizes))]))
    sparse = F.struct(F.lit(categories.n_features).alias("size"), indices.alias("indices"),
                      F.array_repeat(F.lit(1.0), F.size(indices)).alias("values"))
    keep = [c for c in df.columns if c not in categories.sizes and c != output]
    return out.select(*keep, sparse.alias(output))


def as_vector(column: str, size: int) -> Column:
    """The struct as a Spark ML sparse vector of ``size`` (through JSON: the only built-in way into the vector type)."""
    s = F.col(column)
    parts = F.struct(F.lit(0).alias("type"), s["size"].alias("size"), s["indices"].alias("indices"),
                     s["values"].alias("values"))
    wanted = T.StructType([T.StructField("v", VectorUDT())])
    vector = F.from_json(F.to_json(F.struct(parts.alias("v"))), wanted)["v"]
    return vector.alias(column, metadata={"ml_attr": {"num_attrs": size}})     # what VectorAssembler asks for


def inverse_sparse(df: DataFrame, categories: CategoryTable, column: str, indicators: str = "indicators") -> DataFrame:
    """``column`` rebuilt from the sparse indicators; no indicator of it gives the dropped category."""
    first = sum(max(0, n - 1) for c, n in categories.sizes.items() if categories.columns.index(c) < categories.columns.index(column))
    n = categories.sizes[column]
    mine = F.filter(F.col(indicators)["indices"], lambda x: (x >= first) & (x < first + max(0, n - 1)))
    of_column = categories.table.where(F.col("column_name") == column)
    side = of_column.where(F.col("feature").isNotNull()).select(F.col("feature").alias("_k"), F.col("category").alias("_c"))
    dropped = of_column.where(F.col("position") == 0).select("category").scalar()
    out = _looked_up(df, F.get(mine, F.lit(0)), side, categories, column, _salt(df))
    return out.withColumn(column, F.coalesce("_c", dropped)).drop("_c")
