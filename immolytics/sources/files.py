"""File readers and writers.

The reader is chosen by extension like the reference's loader; every reader is a
lazy Spark scan, so a directory of files is read in parallel. JSON may be one
object per line (splittable) or an array in any layout (a task per file): the
first line tells.
"""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.columns import keep_known_columns, nan_to_null, strip_column_names
from ..settings import LOADED_COLUMNS

EXCEL = (".xls", ".xlsx")
# JSON repeats the names on every row: the writers pack it (one file per writing task, so one reading task per file).
PACKED_JSON = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def extension(path: str) -> str:
    return os.path.splitext(path.rstrip("/"))[1].lower()


def is_json_lines(spark: SparkSession, path: str) -> bool:
    """Whether the first line that is not blank is a whole object (reads one line)."""
    lines = spark.read.text(path).select(F.trim(F.regexp_replace("value", r"^\x{FEFF}|\r$", "")).alias("line"))
    first = lines.where("line <> ''").first()
    return first is None or (first["line"].startswith("{") and first["line"].endswith("}"))


def read_file(spark: SparkSession, path: str, delimiter: str = ";", schema: StructType | str | None = None,
              columns: list[str] | None = None, multi_line: bool | None = None, **options) -> DataFrame:
    """Read by extension; ``.xls``/``.xlsx`` and unknown extensions raise ``ValueError``.

    Without a ``schema`` the CSV reader infers types (an extra pass); give one
    for large inputs.
    """
    ext = extension(path)
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if ext in (".csv", ".txt"):                               # S2, S3
        reader = reader.option("sep", delimiter).option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
        df = reader.csv(path)
    elif ext == ".json":                                      # S4
        whole = not is_json_lines(spark, path) if multi_line is None else multi_line
        df = reader.option("multiLine", whole).json(path)
    elif ext == ".parquet":                                   # S5
        df = reader.parquet(path)
    elif ext in EXCEL:
        raise ValueError(f"Extension de fichier '{ext}' non supportée (convertir en CSV).")
    else:
        raise ValueError(f"Extension de fichier '{ext}' non supportée.")
    if columns is not None:                                   # S6: pruned by Catalyst at the scan
        df = df.select(*columns)
    return df


def load_table(spark: SparkSession, path: str, delimiter: str = ";", extra: list[str] = (),
               **kwargs) -> DataFrame:
    """S1 + P1: read a sales file and keep the known columns (absent ones skipped).

    Names lose surrounding blanks and NaN becomes NULL; a file without any known
    column raises ``ValueError``.
    """
    df = strip_column_names(read_file(spark, path, delimiter, **kwargs))
    if not any(c in df.columns for c in LOADED_COLUMNS):
        raise ValueError(f"{path} has none of the known columns (found: {df.columns})")
    return nan_to_null(keep_known_columns(df, LOADED_COLUMNS, extra))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] = ()) -> str:
    """Parquet sink (overwrites by default)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_delimited(df: DataFrame, path: str, delimiter: str = ";") -> str:
    df.write.mode("overwrite").option("sep", delimiter).option("header", True).csv(path)
    return path


def write_json_array(df: DataFrame, path: str) -> str:
    """One JSON array per file (an object a line between the brackets)."""
    def bracketed(batches):
        opened = False
        for batch in batches:
            lines = [f",{x}" for x in batch["value"]]
            if lines and not opened:
                lines[0], opened = "[" + lines[0][1:], True
            yield pd.DataFrame({"value": lines}, dtype=object)
        if opened:
            yield pd.DataFrame({"value": ["]"]})

    objects = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    objects.mapInPandas(bracketed, "value string").write.mode("overwrite").options(**PACKED_JSON).text(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").options(**PACKED_JSON).json(path)
    return path
