"""Correlations of thousands of columns (A9) without a matrix in the driver.

The columns are cut into blocks. Every task adds up, for each pair of blocks, the
six sums a pairwise-complete correlation needs (count, both sums, both squares,
products), by matrix products over its rows; it sends one row per column and
block of partners. Rows of equal keys are added while they stream through sorted
partitions, and leave as ``(col_a, col_b, r)``: no task holds more than its own
sums, and the driver holds one mean per column.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .columns import numeric_columns

BLOCK = 128                          # columns in a block
TASK_BYTES = 256 * 1024 * 1024       # sums that a task holds; more columns read the rows once per such share
CHUNK_VALUES = 1 << 21               # values turned into a matrix at a time
SUMS = 6                             # count, sum a, sum b, squares a, squares b, products
TILE_ROWS = "col int, partners int, sums array<double>"


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """Row blocks of bounded size as float matrices, NaN where a value is missing."""
    rows = max(1, CHUNK_VALUES // max(width, 1))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns])


def _column_sums(width: int):
    def add(batches):
        n, total = np.zeros(width, "int64"), np.zeros(width)
        for x in _chunks(batches, width):
            n += (~np.isnan(x)).sum(axis=0)
            total += np.nansum(x, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype="int32")), pa.array(n), pa.array(total)],
                                         ["col", "n", "total"])
    return add


def _tile(xa, xb, pa_, pb, full: bool) -> np.ndarray:
    """The six sums of two column blocks over the rows of a chunk; ``full``: no value is missing in either."""
    products = xa.T @ xb
    if full:                                          # sums over common rows are then the columns' own sums
        ones = np.ones_like(products)
        return np.stack([ones * len(xa), ones * xa.sum(axis=0)[:, None], ones * xb.sum(axis=0),
                         ones * (xa * xa).sum(axis=0)[:, None], ones * (xb * xb).sum(axis=0), products])
    return np.stack([pa_.T @ pb, xa.T @ pb, pa_.T @ xb, (xa * xa).T @ pb, pa_.T @ (xb * xb), products])


def _tile_sums(pairs: list[tuple[int, int]], used: list[int], means: np.ndarray, block: int):
    """Sums of the given block pairs over a task's rows; the input holds the blocks ``used`` side by side."""
    def add(batches):
        width, sums, seen = sum(len(means[b * block:(b + 1) * block]) for b in used), {}, False
        centre = np.concatenate([means[b * block:(b + 1) * block] for b in used])
        place = {b: i * block for i, b in enumerate(used)}
        with np.errstate(all="ignore"):               # infinities give NaN sums, hence no correlation
            for x in _chunks(batches, width):
                seen = True
                present = ~np.isnan(x)
                x = np.where(present, x - centre, 0.0)
                mask = present.astype(float)
                whole = {b: bool(present[:, i:i + block].all()) for b, i in place.items()}
                for a, b in pairs:
                    i, j = place[a], place[b]
                    tile = _tile(x[:, i:i + block], x[:, j:j + block], mask[:, i:i + block], mask[:, j:j + block],
                                 whole[a] and whole[b])
                    if (a, b) in sums:
                        sums[a, b] += tile
                    else:
                        sums[a, b] = tile
        for (a, b), tile in sums.items() if seen else ():
            yield _rows_of(a * block, b, tile, block)
    return add


def _rows_of(first: int, partners: int, tile: np.ndarray, block: int) -> pa.RecordBatch:
    """A tile as one row per column: its sums with the partner block, filled up to the block's width."""
    wide = np.zeros((tile.shape[1], SUMS, block))
    wide[:, :, :tile.shape[2]] = tile.transpose(1, 0, 2)
    n = len(wide)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype="int32") * (SUMS * block)), pa.array(wide.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(np.arange(first, first + n, dtype="int32")),
                                       pa.array(np.full(n, partners, "int32")), lists], ["col", "partners", "sums"])


def _add_up(cols: list[str], block: int):
    """Add neighbouring rows of equal key and turn each total into correlations."""
    def finish(key: tuple[int, int], total: np.ndarray) -> pa.RecordBatch:
        i, first = key[0], key[1] * block
        partners = np.arange(max(i + 1, first), min(first + block, len(cols)))
        n, sa, sb, saa, sbb, sab = total.reshape(SUMS, block)[:, partners - first]
        with np.errstate(all="ignore"):
            ma, mb, saa, sbb = sa / n, sb / n, saa / n, sbb / n
            va, vb = saa - ma * ma, sbb - mb * mb
            r = (sab / n - ma * mb) / np.sqrt(va * vb)
            known = (n > 0) & (va > 1e-12 * saa) & (vb > 1e-12 * sbb)        # a constant column leaves rounding noise
        return pa.RecordBatch.from_arrays([pa.array([cols[i]] * len(partners), pa.string()),
                                           pa.array([cols[j] for j in partners], pa.string()),
                                           pa.array(r, mask=~known)], ["col_a", "col_b", "r"])

    def add(batches):
        open_key, total = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
            values = batch.column(2).flatten().to_numpy().reshape(len(keys), SUMS * block)
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            for start, part in zip(starts, np.add.reduceat(values, starts, axis=0)):
                key = (int(keys[start, 0]), int(keys[start, 1]))
                if key == open_key:
                    total = total + part
                    continue
                if open_key is not None:
                    yield finish(open_key, total)
                open_key, total = key, part
        if open_key is not None:
            yield finish(open_key, total)
    return add


def wide_correlation(df: DataFrame, columns: list[str] | None = None, block: int = BLOCK,
                     task_bytes: int = TASK_BYTES) -> DataFrame:
    """A9 for any number of columns: Pearson r of every pair i < j as (col_a, col_b, r), distributed.

    Same results as ``stats.correlation_matrix``: pairs are complete rows of the two columns, NaN counts
    as missing, a constant column or a pair without common rows gives NULL, an empty table gives every
    pair with NULL. The rows are read once for the means and once per ``task_bytes`` of sums
    (2,000 columns: once). Fewer than two columns give no rows.
    """
    cols = list(columns or numeric_columns(df))
    spark, p = df.sparkSession, len(cols)
    if p < 2:
        return spark.createDataFrame([], "col_a string, col_b string, r double")
    block = min(block, p)
    number = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))}
    num = df.select(*[(F.col(c) if c in number else F.col(c).cast("double")).alias(f"c{i}")      # tasks turn numbers to doubles
                      for i, c in enumerate(cols)])
    sums = (num.mapInArrow(_column_sums(p), "col int, n bigint, total double")
            .groupBy("col").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())     # a row per column
    means = np.zeros(p)
    for row in sums:
        means[row["col"]] = row["total"] / row["n"] if row["n"] else 0.0

    blocks = range((p + block - 1) // block)
    pairs = [(a, b) for a in blocks for b in blocks if a <= b]
    share = max(1, task_bytes // (SUMS * 8 * block * block))
    parts = [_no_rows(spark, p, block)]
    for start in range(0, len(pairs), share):
        mine = pairs[start:start + share]
        used = sorted({b for pair in mine for b in pair})
        names = [f"c{i}" for b in used for i in range(b * block, min((b + 1) * block, p))]
        parts.append(num.select(*names).mapInArrow(_tile_sums(mine, used, means, block), TILE_ROWS))
    tiles = reduce(DataFrame.unionByName, parts)
    return (tiles.repartition("col", "partners").sortWithinPartitions("col", "partners")
            .mapInArrow(_add_up(cols, block), "col_a string, col_b string, r double"))


def _no_rows(spark, p: int, block: int) -> DataFrame:
    """A row of zeros per column and partner block, so that every pair has a result."""
    return (spark.range(p).select(F.col("id").cast("int").alias("col"))
            .select("col", F.explode(F.sequence(F.floor(F.col("col") / block).cast("int"),
                                                F.lit((p - 1) // block))).alias("partners"),
                    F.array_repeat(F.lit(0.0), SUMS * block).alias("sums")))
