"""Helpers shared by the text operators: batched column appends, words, bounded caches, sampling."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Documents, and bytes of text, handled at a time inside a task (one document may have more bytes).
ROWS_AT_ONCE = 512
BYTES_AT_ONCE = 4 * 1024 * 1024


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def decoded(raw: bytes | None) -> str:
    """Text of a UTF-8 cell; null counts as empty, ill-formed bytes become U+FFFD."""
    return "" if raw is None else raw.decode("utf-8", "replace")


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch within the bounds; column ``text`` holds the UTF-8 cells."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, before = 0, 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(ends, before + BYTES_AT_ONCE, side="right"))
        stop = min(max(stop, at + 1), at + ROWS_AT_ONCE, batch.num_rows)
        yield batch.slice(at, stop - at)
        at, before = stop, int(ends[stop - 1])


def append_columns(df: DataFrame, fields: Sequence[tuple[str, T.DataType]],
                   make_compute: Callable[[], Callable[[list[bytes | None]], list]],
                   text: str = "text", keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row plus ``fields`` computed from its whole text.

    ``make_compute`` runs once per task and returns a function from a list of
    UTF-8 cells (None for null) to one list or array per field. Rows pass
    through in place: no shuffle, a bounded number of texts at a time. An input
    column named like a new field is replaced by the new field.
    """
    new = {n for n, _ in fields}
    kept = [c for c in dict.fromkeys(keep) if c not in new]
    frame = df.select(*[F.col(quoted(c)) for c in kept],
                      F.col(quoted(text)).cast("binary").alias("__text"))
    schema = T.StructType([frame.schema[c] for c in kept] + [T.StructField(n, t) for n, t in fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make_compute()
        for batch in batches:
            for part in slices(batch, len(kept)):
                found = compute(part.column(len(kept)).to_pylist())
                made = [pa.array(v, type=arrow.field(len(kept) + i).type) for i, v in enumerate(found)]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(kept))] + made,
                                                 schema=arrow)

    return frame.mapInArrow(run, schema)


class Memo(dict):
    """A dictionary that computes absent entries; emptied at ``limit`` entries, so memory stays bounded."""

    def __init__(self, compute: Callable, limit: int = 400_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def segment_sums(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments of ``values`` (rows), zero for empty segments."""
    out = np.zeros((len(starts),) + values.shape[1:], values.dtype)
    full = lengths > 0
    if full.any():
        out[full] = np.add.reduceat(values, starts[full], axis=0)
    return out


def fold_of(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds`` (0 for a null id)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % folds, F.lit(0)).cast("int")


def bounded_sample(df: DataFrame, rows: int, *order: str) -> DataFrame:
    """The ``rows`` rows of smallest hash of ``order`` (a documented bound for fitting classifiers).

    Rows whose hash is too large to be chosen are dropped where they are read, so
    that about twice the bound is sorted whatever the number of tasks.
    """
    share = min(1.0, 2 * (rows + 1000) / max(1, df.count()))
    hashed = df.withColumn("__h", F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in order]), F.lit(1 << 40)))
    few = hashed.where(F.col("__h") < int(share * (1 << 40)))
    return few.orderBy("__h", *[F.col(quoted(c)) for c in order]).limit(rows).drop("__h")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, folds: int) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents outside the held-out fold 0.

    The label rows are cut to the bound first, so the side that is broadcast
    has at most ``rows`` rows whatever the size of the tables.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold_of("doc_id", folds) != 0))
    picked = bounded_sample(known.select("doc_id", F.col(label).cast("int").alias("__label")), rows, "doc_id")
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
