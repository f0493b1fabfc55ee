import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from immolytics.operators.correlation import wide_correlation
from immolytics.operators.stats import correlation_matrix
from immolytics.plans.binding import NUMERIC_COLUMNS
from immolytics.session import materialize


def pairs(frame):
    rows = frame.collect()
    out = {(r["col_a"], r["col_b"]): r["r"] for r in rows}
    assert len(out) == len(rows)
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for key, r in want.items():
        assert (got[key] is None) == (r is None), key
        assert r is None or math.isclose(got[key], r, rel_tol=1e-9, abs_tol=1e-12), key


def thirteen(spark, rows=900):
    """13 columns with gaps, NaN, a constant, a column of gaps alone and a far-off mean."""
    cols = [(F.sin(F.col("id") * (i + 1)) * 10 + F.col("id") * (i % 3)).alias(c) for i, c in enumerate(NUMERIC_COLUMNS)]
    df = spark.range(rows).select("id", *cols)
    df = (df.withColumn(NUMERIC_COLUMNS[1], F.when(F.col("id") % 3 != 0, F.col(NUMERIC_COLUMNS[1])))
          .withColumn(NUMERIC_COLUMNS[4], F.when(F.col("id") % 7 == 0, float("nan")).otherwise(F.col(NUMERIC_COLUMNS[4])))
          .withColumn(NUMERIC_COLUMNS[6], F.lit(4.25)).withColumn(NUMERIC_COLUMNS[8], F.lit(None).cast("double"))
          .withColumn(NUMERIC_COLUMNS[9], F.col(NUMERIC_COLUMNS[9]) + 1e9))
    return df.drop("id")


@pytest.mark.parametrize("block, task_bytes", [(128, 1 << 28), (4, 1 << 28), (5, 1), (1, 2000)])
def test_same_as_the_matrix_in_the_driver(spark, block, task_bytes):
    df = thirteen(spark).repartition(5)
    same(pairs(wide_correlation(df, NUMERIC_COLUMNS, block, task_bytes)), pairs(correlation_matrix(df, NUMERIC_COLUMNS)))


def test_two_thousand_columns(spark, tmp_path):
    rows, p = 60, 2000
    x = np.random.default_rng(5).normal(size=(rows, p)) + np.arange(p)
    x[:, 7] = x[:, 1500] * -2
    for part in range(3):
        pq.write_table(pa.table({f"x{i}": x[part * 20:part * 20 + 20, i] for i in range(p)}), f"{tmp_path}/{part}.parquet")
    want = np.corrcoef(x.T)
    corr = materialize(wide_correlation(spark.read.parquet(str(tmp_path))), "wide")
    assert corr.count() == p * (p - 1) // 2 == corr.select("col_a", "col_b").distinct().count()
    got = corr.toPandas()
    i, j = (got[c].str[1:].astype(int).to_numpy() for c in ("col_a", "col_b"))
    assert (i < j).all() and np.allclose(got["r"].to_numpy(), want[i, j], atol=1e-9)


def test_numbers_of_every_type(spark):
    rows = [(1, True, 2.5, "1.5", 10), (2, False, 3.5, "2", None), (3, None, 1.25, "x", 30), (5, True, None, "4", 45)]
    df = spark.createDataFrame([(a, b, c, d, e) for a, b, c, d, e in rows], "a int, b boolean, c float, d string, e long")
    df = df.select("a", "b", "c", F.expr("try_cast(d AS double)").alias("d"), F.col("e").cast("decimal(10,2)").alias("e"))
    cols = ["a", "b", "c", "d", "e"]
    same(pairs(wide_correlation(df, cols, 2)), pairs(correlation_matrix(df, cols)))


def test_empty_table_few_columns_and_infinity(spark):
    df = thirteen(spark)
    assert set(pairs(wide_correlation(df.limit(0), NUMERIC_COLUMNS, 4)).values()) == {None}
    assert len(pairs(wide_correlation(df.limit(0), NUMERIC_COLUMNS))) == 78
    assert wide_correlation(df, NUMERIC_COLUMNS[:1]).count() == 0
    odd = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 4.5, float("inf")), (3.0, 5.5, 2.0)], "a double, b double, c double")
    got = pairs(wide_correlation(odd))
    assert got["a", "c"] is None and got["b", "c"] is None and 0.9 < got["a", "b"] < 1


def test_driver_gets_one_row_per_column_only(spark):
    """The plan ends in a map over sorted partitions: no pair passes through the driver."""
    corr = wide_correlation(thirteen(spark), NUMERIC_COLUMNS, 4)
    plan = corr._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("MapInArrow") and "LocalRelation" not in plan
