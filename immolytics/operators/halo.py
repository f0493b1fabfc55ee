"""Windows over the last few rows of a group, in blocks of bounded size.

A window partitioned by the group alone puts a group's whole history into one
task. Here the rows of a group are numbered in order without gathering them,
cut into blocks, and every block also gets the last rows of the one before (its
halo), so a frame that looks a fixed number of rows back has all it needs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..session import materialize

BLOCK_ROWS = 100_000


def numbered_in_groups(df: DataFrame, keys: list[str], order: list[str], column: str = "_rank") -> DataFrame:
    """``column``: place (from 0) of every row in its group, in the order of ``order`` (no two rows alike in it).

    Rows are range-partitioned by (keys, order) and written with the number of their
    slice; a place is the rank within the slice plus the group's rows in the slices
    before. The table of those has a row per group and slice. NULL keys are a group.
    """
    sliced = materialize(df.repartitionByRange(*keys, *order).withColumn("_slice", F.spark_partition_id()), "slices")
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
               .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_slice").alias("_at"),
                       F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    own = sliced.withColumn("_own", F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*order)))
    same = [F.col("_slice") == F.col("_at")] + [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return (own.join(offsets, reduce(lambda a, b: a & b, same))
            .withColumn(column, F.col("_offset") + F.col("_own") - 1)
            .drop("_slice", "_at", "_own", "_offset", *[f"_k_{k}" for k in keys]))


def in_blocks(df: DataFrame, keys: list[str], order: list[str], back: int,
              columns: Callable[[WindowSpec], dict[str, Column]], block: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with ``columns(window)``, whose frames look at most ``back`` rows back and none ahead.

    The window's partitions hold at most ``block + back`` rows; only the halos travel twice.
    """
    if not 0 <= back <= block:
        raise ValueError(f"blocks of {block} rows cannot look {back} rows back")
    number = F.floor(F.col("_rank") / block)
    last = F.pmod(F.col("_rank"), F.lit(block)) >= block - back
    rows = (numbered_in_groups(df, keys, order)
            .withColumn("_ahead", F.explode(F.when(last, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .withColumn("_block", number + F.col("_ahead")))
    window = Window.partitionBy(*keys, "_block").orderBy("_rank")
    return rows.withColumns(columns(window)).where(F.col("_ahead") == 0).drop("_rank", "_ahead", "_block")
