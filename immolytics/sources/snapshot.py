"""Write-once reference snapshot for data-drift monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import commits
from ..operators import splits
from ..session import path_exists
from ..settings import RANDOM_STATE, REFERENCE_FRACTION


def reference_and_current(spark: SparkSession, current: DataFrame, path: str, key_columns: list[str],
                          order_columns: list[str] | None = None, frac: float = REFERENCE_FRACTION,
                          seed: int = RANDOM_STATE, verify: bool = False) -> tuple[DataFrame, DataFrame]:
    """First run: split ``current`` (time order if ``order_columns``, else a seeded
    sample), store the reference part and compare it with the rest. Later runs read
    the stored reference and compare it with all current rows.

    The reference appears by one rename (``sources.commits``): a writer that is
    killed leaves none, and of two first writers one stores it; the other reads
    that one and compares all its rows, as a later run does. A folder without a
    manifest is refused; ``verify`` also counts and hashes the stored rows.
    """
    if path_exists(spark, path):
        return commits.read(spark, path, verify), current
    if order_columns:
        tagged = splits.temporal_split(current, order_columns, frac)
    else:
        tagged = splits.sample_reference(current, key_columns, frac, seed)
    ref = tagged.where(F.col("dataset") == "reference").drop("dataset")
    if not commits.commit(spark, commits.stage(ref, path), path):
        return commits.read(spark, path, verify), current
    cur = tagged.where(F.col("dataset") == "current").drop("dataset")
    return commits.read(spark, path), cur
