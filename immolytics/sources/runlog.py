"""Run log (S9, S10): runs, params, metrics and tags as a versioned table in a shared folder.

Every commit is a folder ``v<number>`` that appears by one rename
(``sources.commits``): what is logged in one commit is seen as a whole or not at
all, and writers that meet take the next number. ``RunLog.run`` gathers a whole
run into one commit. After ``COMPACT_EVERY`` commits all rows so far are written
again as one folder ``c<number>``, with the version of each row, so the number
of files stays bounded and any earlier version can still be read.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import commits

COMPACT_EVERY = 64
ROWS = ("run_id string, kind string, key string, value string, number double, parent_run_id string, start_time timestamp_ntz")
COLUMNS = [c.split()[0] for c in ROWS.split(", ")]


class Run:
    """What one run logs, as rows; committed by ``RunLog.run``."""

    def __init__(self, run_id: str):
        self.run_id, self.rows, self.frames = run_id, [], []

    def log_params(self, params: dict) -> None:
        self.rows += [(self.run_id, "param", k, str(v), None, None, None) for k, v in params.items()]

    def log_tags(self, tags: dict) -> None:
        self.rows += [(self.run_id, "tag", k, str(v), None, None, None) for k, v in tags.items()]

    def log_metrics(self, metrics: dict) -> None:
        self.rows += [(self.run_id, "metric", k, None, float(v), None, None) for k, v in metrics.items()]

    def log_metrics_frame(self, df: DataFrame, key: str, value: str) -> None:
        """Metrics straight from a DataFrame (no collect)."""
        none = F.lit(None).cast("string")
        self.frames.append(df.select(
            F.lit(self.run_id).alias("run_id"), F.lit("metric").alias("kind"), F.col(key).cast("string").alias("key"), none.alias("value"),
            F.col(value).cast("double").alias("number"), none.alias("parent_run_id"), F.lit(None).cast("timestamp_ntz").alias("start_time")))


class RunLog:
    def __init__(self, spark: SparkSession, root: str, compact_every: int = COMPACT_EVERY):
        self.spark, self.root, self.compact_every = spark, root.rstrip("/"), compact_every

    # ---- writing -------------------------------------------------------
    def _commit(self, run: Run) -> int:
        frames = [self.spark.createDataFrame(run.rows, ROWS).coalesce(1)] if run.rows else []
        df = None
        for frame in frames + run.frames:
            df = frame if df is None else df.unionByName(frame)
        if df is None:
            return self.version()
        while True:
            version = self.version() + 1
            final = f"{self.root}/v{version:020d}"
            if commits.commit(self.spark, commits.stage(df, final), final):
                break
        if version % self.compact_every == 0:
            self.compact()
        return version

    @contextlib.contextmanager
    def run(self, name: str, tags: dict[str, str] | None = None, parent_id: str | None = None,
            params: dict | None = None) -> Iterator[Run]:
        """A run whose rows are committed together when the block ends; nothing if it raises."""
        run = self._new(name, tags, parent_id, params)
        yield run
        self._commit(run)

    def _new(self, name, tags, parent_id, params) -> Run:
        run = Run(uuid.uuid4().hex)
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        run.rows.append((run.run_id, "run", name, None, None, parent_id, now))
        run.log_tags(tags or {})
        run.log_params(params or {})
        return run

    def start_run(self, name: str, tags: dict[str, str] | None = None, parent_id: str | None = None,
                  params: dict | None = None) -> str:
        """Commit a run with its tags and params; metrics may follow in commits of their own."""
        run = self._new(name, tags, parent_id, params)
        self._commit(run)
        return run.run_id

    def _later(self, run_id: str, method: str, *args) -> None:
        run = Run(run_id)
        getattr(run, method)(*args)
        self._commit(run)

    def log_params(self, run_id: str, params: dict) -> None:
        self._later(run_id, "log_params", params)

    def log_tags(self, run_id: str, tags: dict) -> None:
        self._later(run_id, "log_tags", tags)

    def log_metrics(self, run_id: str, metrics: dict) -> None:
        self._later(run_id, "log_metrics", metrics)

    def log_metrics_frame(self, run_id: str, df: DataFrame, key: str, value: str) -> None:
        self._later(run_id, "log_metrics_frame", df, key, value)

    # ---- versions ------------------------------------------------------
    def _folders(self) -> tuple[list[int], list[int]]:
        """Numbers of the commits and of the compactions that stand in the folder."""
        found = commits.names(self.spark, self.root)
        return [int(n[1:]) for n in found if n[0] == "v"], [int(n[1:]) for n in found if n[0] == "c"]

    def version(self) -> int:
        """The newest version; 0 before the first commit."""
        return max([0, *sum(self._folders(), [])])

    def _rows(self, as_of: int | None = None) -> DataFrame:
        single, compacted = self._folders()
        base = max(compacted, default=0)
        later = [f"{self.root}/v{v:020d}" for v in single if v > base]
        out = self.spark.createDataFrame([], f"version long, {ROWS}")
        if later:
            number = F.regexp_extract(F.col("_metadata.file_path"), r"/v([0-9]{20})/", 1).cast("long")
            out = self.spark.read.schema(ROWS).parquet(*later).select(number.alias("version"), *COLUMNS)
        if base:
            out = out.unionByName(self.spark.read.schema(f"version long, {ROWS}").parquet(f"{self.root}/c{base:020d}"))
        return out if as_of is None else out.where(F.col("version") <= as_of)

    def compact(self) -> None:
        """Write all rows so far as one folder, then remove what the compaction before the last one made needless."""
        single, compacted = self._folders()
        newest = max(single, default=0)
        if newest <= max(compacted, default=0):
            return
        final = f"{self.root}/c{newest:020d}"
        commits.commit(self.spark, commits.stage(self._rows(newest).coalesce(1), final), final)
        # Readers that listed the folder a moment ago still find the files of the compaction before.
        keep = max(compacted, default=0)
        for prefix, numbers in (("v", [v for v in single if v <= keep]), ("c", [c for c in compacted if c < keep])):
            for n in numbers:
                commits.remove(self.spark, f"{self.root}/{prefix}{n:020d}")

    # ---- reading -------------------------------------------------------
    def table(self, name: str, as_of: int | None = None) -> DataFrame:
        """``runs``, ``params``, ``metrics`` or ``tags``, as of a version (default: the newest)."""
        rows = self._rows(as_of)
        if name == "runs":
            return rows.where("kind = 'run'").select("run_id", F.col("key").alias("run_name"), "parent_run_id", "start_time")
        kind = {"params": "param", "metrics": "metric", "tags": "tag"}[name]
        value = F.col("number").alias("value") if name == "metrics" else F.col("value")
        return rows.where(F.col("kind") == kind).select("run_id", "key", value)


def _newest(runs: DataFrame) -> DataFrame:
    """The newest run, one row or none (ties to the larger id)."""
    newest = F.max_by(F.struct("run_id", "run_name", "start_time"), F.struct("start_time", "run_id")).alias("r")
    return runs.agg(newest).where(F.col("r").isNotNull()).select("r.*")


def latest_run(runs: DataFrame, tags: DataFrame, run_type: str = "model_training") -> DataFrame:
    """Newest run tagged ``Run_Type=run_type``: the run whose model is evaluated or checked for drift."""
    tagged = tags.where((F.col("key") == "Run_Type") & (F.col("value") == run_type)).select("run_id")
    return _newest(runs.join(tagged, "run_id", "left_semi"))


def latest_parent_run(runs: DataFrame, name_prefix: str = "training_") -> DataFrame:
    """Newest run named ``name_prefix...``: the parent that later runs are nested in."""
    return _newest(runs.where(F.col("run_name").startswith(name_prefix)))


def require_run(df: DataFrame) -> str:
    row = df.first()
    if row is None:
        raise RuntimeError("no training run found")
    return row["run_id"]
