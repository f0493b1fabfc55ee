"""Commits on a shared file system: what is written becomes visible by one step, or not at all.

A table is staged in a folder of its own together with a manifest: the number of
rows, an order-free digest of them and the commit's own id. One rename of the
folder makes both visible under the final name. Renaming never replaces a folder
that holds something, so of several writers the one whose manifest stands under
the final name has won; the others find another id there. A killed writer leaves
a staged folder that readers never look at (its name begins with ``_``).

This holds where renaming a folder is atomic (HDFS, local and network disks);
an object store needs a committer that gives the same.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

MANIFEST = "_manifest.json"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names of a folder's entries; none if it does not exist."""
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest of a committed folder; None without one."""
    fs, p = _fs(spark, f"{path}/{MANIFEST}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def contents(df: DataFrame) -> tuple[int, str]:
    """(rows, digest): the digest is a sum of row hashes, whatever the order of the rows."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("d")).first()
    return int(row["n"]), str(row["d"] or 0)


def stage(df: DataFrame, final: str, **facts) -> str:
    """Write ``df`` and its manifest beside ``final``; returns the staged folder."""
    spark = df.sparkSession
    parent, _, name = final.rstrip("/").rpartition("/")
    commit = uuid.uuid4().hex
    staged = f"{parent}/_staged-{name}-{commit}"
    df.write.mode("errorifexists").parquet(staged)
    rows, digest = contents(spark.read.schema(df.schema).parquet(staged))
    _write_text(spark, f"{staged}/{MANIFEST}", json.dumps({"commit": commit, "rows": rows, "digest": digest, **facts}))
    return staged


def commit(spark: SparkSession, staged: str, final: str) -> bool:
    """Rename the staged folder to ``final``; false, and the staged folder gone, if another commit stands there."""
    mine = manifest(spark, staged)["commit"]
    fs, source = _fs(spark, staged)
    _, target = _fs(spark, final)
    if not fs.exists(target):
        fs.rename(source, target)
    now = manifest(spark, final)
    if now is not None and now["commit"] == mine:
        return True
    remove(spark, staged)
    # A rename onto a folder that appeared meanwhile moves into it; the name keeps readers from looking.
    remove(spark, f"{final}/{staged.rpartition('/')[2]}")
    return False


def read(spark: SparkSession, path: str, verify: bool = False) -> DataFrame:
    """A committed table; raises if ``path`` holds no manifest, or (``verify``) not the rows that it tells."""
    told = manifest(spark, path)
    if told is None:
        raise RuntimeError(f"{path} holds no committed table: remove it")
    df = spark.read.parquet(path)
    if verify and contents(df) != (told["rows"], told["digest"]):
        raise RuntimeError(f"{path} does not hold the {told['rows']} rows of its manifest")
    return df
