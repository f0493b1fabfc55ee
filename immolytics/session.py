"""Spark session and shared scratch locations."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "immolytics",
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the time zone pinned to UTC."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set (a shared file system). Only a local-mode
    session without one gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="immolytics-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(path)
    return path


_CLEANED: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    All scratch of an application lies in one folder of its own, which is removed
    when the driver exits.
    """
    folder = f"{checkpoint_dir(spark).rstrip('/')}/immolytics-{spark.sparkContext.applicationId}"
    if folder not in _CLEANED:
        _CLEANED.add(folder)
        sc = spark.sparkContext
        atexit.register(_remove, sc._jvm, sc._jsc.hadoopConfiguration(), folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def _remove(jvm, hadoop_conf, folder: str) -> None:
    """Delete a scratch folder through Hadoop's file system; the JVM outlives the session."""
    with contextlib.suppress(Exception):                    # the JVM may be gone already
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop_conf).delete(path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop FileSystem API (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(hconf).exists(p)



def materialize(df, name: str):
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage of a frame that several jobs re-read (split levels, folds,
    drift sides): downstream jobs scan columnar files instead of re-running the
    joins, and a lost executor only re-reads files.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
