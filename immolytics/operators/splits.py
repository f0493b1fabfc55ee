"""Exact, reproducible splits without a global sort.

Every split is "the first r rows in some total order". The order is a string
sort key (fixed-width hex fields, or an md5 shuffle key, then the row key); the
split is the predicate ``sort_key <= cut`` for a few cut values. The cut at rank
r is found exactly by :func:`rank_cuts`, which narrows the candidates with
prefix histograms: each level is one aggregate whose output is bounded by
``#cuts x 16^chunk`` groups (4,096 per cut by default), so no task or driver ever holds the rows, and a
hot value (a third of the rows in one month, say) is split by later key
characters rather than landing in one partition. The final exact ranking runs
on at most ``final_limit`` candidate rows per cut.
"""

from __future__ import annotations

import math
import os
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..settings import N_SPLITS, RANDOM_STATE, REFERENCE_FRACTION, TEST_SIZE

KEY = "_sort_key"
MIN_LONG = -(2 ** 63)
LEADS = 100_000             # most values of the leading order columns whose counts the driver takes


# ------------------------------------------------------------------ sort keys
def _hex64(c: Column) -> Column:
    """Order-preserving 16-character hex of a signed 64-bit integer."""
    return F.lpad(F.hex(c.cast("bigint").bitwiseXOR(F.lit(MIN_LONG))), 16, "0")


def _ntz_micros(c: Column) -> Column:
    day = F.unix_date(c.cast("date")).cast("bigint")
    secs = day * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
    frac = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    return secs * 1_000_000 + frac


def order_key(df: DataFrame, columns: list[str]) -> Column:
    """A string whose lexicographic order is the ascending order of ``columns``.

    Integral, boolean, date and timestamp columns become fixed-width hex; a
    string column is allowed only in last position (the hex of its UTF-8 bytes,
    so that a prefix histogram has at most 16 groups per character).
    Nulls are not allowed in order columns.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for i, c in enumerate(columns):
        t = types[c]
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
            parts.append(_hex64(F.col(c).cast("bigint")))
        elif isinstance(t, T.TimestampType):
            parts.append(_hex64(F.unix_micros(F.col(c))))
        elif isinstance(t, T.TimestampNTZType):          # wall-clock value, independent of the session zone
            parts.append(_hex64(_ntz_micros(F.col(c))))
        elif isinstance(t, T.DateType):
            parts.append(_hex64(F.unix_date(F.col(c))))
        elif isinstance(t, T.StringType) and i == len(columns) - 1:
            parts.append(F.hex(F.col(c)))
        else:
            raise TypeError(f"cannot order by {c} ({t.simpleString()}) in this position")
    return F.concat(*parts)


def shuffle_key(key_columns: list[str], seed: int = RANDOM_STATE) -> Column:
    """A seeded pseudo-random order: md5 of ``seed|key`` (32 hex chars), then the hex of the key."""
    raw = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_columns])
    return F.concat(F.md5(raw), F.hex(F.concat_ws("|", *[F.col(c).cast("string") for c in key_columns])))


# ------------------------------------------------------------------ selection
def rank_cuts(df: DataFrame, key: Column, ranks: list[int], chunk: int = 3,
              final_limit: int = 50_000) -> dict[int, str]:
    """The sort-key value at each 1-based rank in ``ranks``; equal keys on both sides of a rank are an error."""
    return cuts_at(df, key, lambda n: ranks, chunk, final_limit)[1]


def cuts_at(df: DataFrame, key: Column, ranks_of_n, chunk: int = 3,
            final_limit: int = 50_000) -> tuple[int, dict[int, str]]:
    """Row count and the sort-key values at the ranks ``ranks_of_n(n)``.

    Only the key column is kept (memory and disk) while the levels run; a lost
    block is recomputed from lineage.
    """
    keys = df.select(key.alias(KEY)).persist(StorageLevel.MEMORY_AND_DISK)

    def histogram(prefixes: list[str], level: int) -> list:
        sub = keys if level == 0 else keys.where(F.substring(KEY, 1, level).isin(prefixes))
        return (sub.groupBy(F.substring(KEY, 1, level).alias("p"), F.substring(KEY, level + 1, chunk).alias("c"))
                   .agg(F.count(F.lit(1)).alias("n")).collect())    # counts alone are hashed: least and greatest strings would sort all rows

    def extents(buckets: list[str], length: int) -> dict[str, tuple[str, str]]:
        found = (keys.where(F.substring(KEY, 1, length).isin(buckets)).groupBy(F.substring(KEY, 1, length).alias("b"))
                 .agg(F.min(KEY).alias("lo"), F.max(KEY).alias("hi")).collect())
        return {r["b"]: (r["lo"], r["hi"]) for r in found}

    try:
        first = histogram([""], 0)                  # also gives the row count: no separate count job
        n = sum(r["n"] for r in first)
        ranks = [r for r in ranks_of_n(n) if r > 0]
        if any(r > n for r in ranks):
            raise ValueError("rank beyond the number of rows")
        state = {r: ("", r) for r in set(ranks)}       # rank -> (prefix, rank within prefix)
        done: dict[int, str] = {}
        final: dict[int, tuple[str, int]] = {}
        while len(done) + len(final) < len(state):
            open_ = {r: v for r, v in state.items() if r not in done and r not in final}
            prefixes = sorted({p for p, _ in open_.values()})
            lengths = {len(p) for p in prefixes}
            if len(lengths) > 1:                    # one level at a time: shortest prefixes first
                level = min(lengths)
                open_ = {r: v for r, v in open_.items() if len(v[0]) == level}
                prefixes = sorted({p for p, _ in open_.values()})
            level = len(prefixes[0])
            hist, first = (first, None) if (level == 0 and first is not None) else (histogram(prefixes, level), None)
            by_prefix: dict[str, list[tuple]] = {}
            for row in hist:
                by_prefix.setdefault(row["p"], []).append((row["c"], row["n"]))
            large: dict[int, tuple[str, int, int]] = {}
            for r, (p, rem) in open_.items():
                cum = 0
                for c, cnt in sorted(by_prefix.get(p, [])):
                    if cum + cnt >= rem:
                        if cnt <= final_limit:
                            final[r] = (p + c, rem - cum)
                        else:
                            large[r] = (p + c, rem - cum, cnt)
                        break
                    cum += cnt
                else:
                    raise ValueError(f"rank {r} is beyond the number of rows")
            ends = extents(sorted({b for b, *_ in large.values()}), level + chunk) if large else {}
            for r, (bucket, rem, cnt) in large.items():
                lo, hi = ends[bucket]
                if lo == hi:                        # every key in the bucket is the same
                    if rem < cnt:
                        raise ValueError(f"the order key is not unique at rank {r}: {cnt} equal keys")
                    done[r] = lo
                # all keys of the bucket share the common prefix of its min and max
                state[r] = (os.path.commonprefix([lo, hi]), rem)
        if final:
            # Final prefixes never nest (a bucket small enough for one rank is final for all).
            cands = None
            for p in sorted({p for p, _ in final.values()}):
                c = keys.where(F.startswith(F.col(KEY), F.lit(p))).withColumn("_p", F.lit(p))
                cands = c if cands is None else cands.unionByName(c)
            w = Window.partitionBy("_p").orderBy(KEY)
            ranked = cands.withColumn("_rn", F.row_number().over(w)).withColumn("_next", F.lead(KEY).over(w))
            wanted = reduce(lambda a, b: a | b,
                            [(F.col("_p") == p) & (F.col("_rn") == k) for p, k in final.values()])
            rows = ranked.where(wanted).select("_p", "_rn", KEY, "_next").collect()
            found = {(row["_p"], row["_rn"]): row for row in rows}
            for r, (p, k) in final.items():
                row = found[(p, k)]
                if row["_next"] == row[KEY]:
                    raise ValueError(f"the order key is not unique at rank {r}")
                done[r] = row[KEY]
        return n, {r: done[r] for r in ranks}
    finally:
        keys.unpersist()


def bucket_by_cuts(key: Column, cuts: list[str]) -> Column:
    """0 for keys <= cuts[0], 1 for keys in (cuts[0], cuts[1]], ...; len(cuts) beyond the last."""
    return _first_true([key <= F.lit(c) for c in cuts])


def _first_true(conditions: list[Column]) -> Column:
    """Number of the first condition that holds; their number if none does."""
    expr = F.lit(len(conditions))
    for i in reversed(range(len(conditions))):
        expr = F.when(conditions[i], F.lit(i)).otherwise(expr)
    return expr


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def with_buckets(df: DataFrame, order_columns: list[str], ranks_of_n, column: str) -> DataFrame:
    """``bucket_by_cuts`` at the ranks ``ranks_of_n(n)`` in the order of the columns.

    If the columns before the last have few values (year and month), their counts tell
    which values hold the ranks, and only the rows of these few build a sort key, to
    be ranked and to be compared; the others are placed by the columns themselves.
    """
    key, lead = order_key(df, order_columns), order_columns[:-1]
    keyed = _all([F.col(c).isNotNull() for c in order_columns])
    counts = []
    if lead and all(isinstance(df.schema[c].dataType, (T.IntegralType, T.BooleanType)) for c in lead):
        counts = df.groupBy(*lead).agg(F.count(F.lit(1)).alias("_n"), F.count_if(keyed).alias("_keyed")).limit(LEADS + 1).collect()
    if not 0 < len(counts) <= LEADS:
        _, cuts = cuts_at(df, key, ranks_of_n)
        return df.withColumn(column, bucket_by_cuts(key, [cuts[r] for r in sorted(cuts)]))
    ranks = sorted({r for r in ranks_of_n(sum(r["_n"] for r in counts)) if r > 0})
    held, in_held, before, skipped = [], [], 0, 0                       # values that hold ranks; the ranks among their rows
    for values, n in sorted((tuple(r[c] for c in lead), r["_keyed"]) for r in counts if r["_keyed"]):
        own = [r for r in ranks if before < r <= before + n]
        before += n
        if own:
            held += [values] * len(own)
            in_held += [r - skipped for r in own]
        else:
            skipped += n
    if len(held) < len(ranks):
        raise ValueError(f"rank {ranks[len(held)]} is beyond the number of rows")
    if not ranks:
        return df.withColumn(column, F.lit(0))
    few = df.where(reduce(lambda a, b: a | b, [_all([F.col(c) == v for c, v in zip(lead, values)]) for values in dict.fromkeys(held)]))
    _, cuts = cuts_at(few, key, lambda _: in_held)

    def up_to(values: tuple, cut: str) -> Column:
        upto = key <= F.lit(cut)
        for c, v in reversed(list(zip(lead, values))):
            upto = (F.col(c) < v) | ((F.col(c) == v) & upto)
        return keyed & upto

    return df.withColumn(column, _first_true([up_to(values, cuts[r]) for values, r in zip(held, in_held)]))


def first_rows(df: DataFrame, key: Column, n_first_of_n, flag: str) -> DataFrame:
    """Add ``flag`` = true for the ``n_first_of_n(n)`` first rows in ``key`` order."""
    n, cuts = cuts_at(df, key, lambda n: [n_first_of_n(n)])
    if not cuts:
        return df.withColumn(flag, F.lit(False))
    return df.withColumn(flag, key <= F.lit(next(iter(cuts.values()))))


# ------------------------------------------------------------------ E1, E2, J3
def with_split(df: DataFrame, key_columns: list[str], test_size: float = TEST_SIZE,
               seed: int = RANDOM_STATE, column: str = "split") -> DataFrame:
    """``split`` = 'test' for ceil(test_size * n) rows drawn by a seeded hash, else 'train'."""
    out = first_rows(df, shuffle_key(key_columns, seed), lambda n: math.ceil(test_size * n), "_is_test")
    return out.withColumn(column, F.when(F.col("_is_test"), "test").otherwise("train")).drop("_is_test")


def train_test_split(df: DataFrame, key_columns: list[str], test_size: float = TEST_SIZE,
                     seed: int = RANDOM_STATE) -> tuple[DataFrame, DataFrame]:
    """E1 as two frames (train, test); disjoint and exhaustive."""
    s = with_split(df, key_columns, test_size, seed, "_split")
    return (s.where(F.col("_split") == "train").drop("_split"),
            s.where(F.col("_split") == "test").drop("_split"))


def sample_reference(df: DataFrame, key_columns: list[str], frac: float = REFERENCE_FRACTION,
                     seed: int = RANDOM_STATE, salt: str = "reference") -> DataFrame:
    """E2 + J3: ``dataset`` = 'reference' for round(frac * n) seeded rows, 'current' for the complement."""
    key = shuffle_key(key_columns, f"{seed}-{salt}")
    out = first_rows(df, key, lambda n: round(frac * n), "_ref")
    return out.withColumn("dataset", F.when(F.col("_ref"), "reference").otherwise("current")).drop("_ref")


def complement(current: DataFrame, reference: DataFrame, key_columns: list[str]) -> DataFrame:
    """Rows of ``current`` whose key is not in ``reference`` (anti join)."""
    return current.join(reference.select(*key_columns), key_columns, "left_anti")


# ------------------------------------------------------------------ T5, T6
def head_tail_split(df: DataFrame, order_columns: list[str], n_head_of_n,
                    column: str = "dataset", head: str = "reference", tail: str = "current") -> DataFrame:
    key = order_key(df, order_columns)
    out = first_rows(df, key, n_head_of_n, "_head")
    return out.withColumn(column, F.when(F.col("_head"), head).otherwise(tail)).drop("_head")


def temporal_split(df: DataFrame, order_columns: list[str], frac: float = REFERENCE_FRACTION) -> DataFrame:
    """T5: the first floor(frac * n) rows in time order are the reference."""
    return head_tail_split(df, order_columns, lambda n: int(frac * n))


def positional_halves(df: DataFrame, order_columns: list[str]) -> DataFrame:
    """The first n // 2 rows by an explicit key are the reference, the rest current."""
    return head_tail_split(df, order_columns, lambda n: n // 2)


# ------------------------------------------------------------------ E7, E8
def time_series_blocks(df: DataFrame, order_columns: list[str], n_splits: int = N_SPLITS,
                       column: str = "block") -> DataFrame:
    """Expanding-window folds as blocks.

    Test blocks hold n // (n_splits + 1) rows each and end at the last row;
    block 0 is everything before the first test block. Fold i (1..n_splits)
    trains on blocks < i and tests on block i.
    """
    def bounds(n):                                          # last rank before each test block
        size = n // (n_splits + 1)
        if size == 0:
            raise ValueError(f"cannot make {n_splits} folds of {n} rows")
        return [n - n_splits * size + i * size for i in range(n_splits)]

    return with_buckets(df, order_columns, bounds, column)


def group_folds(df: DataFrame, group_columns: list[str], k: int = N_SPLITS, column: str = "fold") -> DataFrame:
    """Folds 0..k-1 by a hash of the group, so that all rows of a group share a fold."""
    if k < 2:
        raise ValueError(f"cannot make {k} folds")
    return df.withColumn(column, F.pmod(F.xxhash64(*group_columns), F.lit(k)).cast("int"))


def balanced_folds(df: DataFrame, group_columns: list[str], k: int = N_SPLITS, column: str = "fold") -> DataFrame:
    """Folds 0..k-1 of whole groups whose sizes differ by the largest group at most.

    Groups are dealt to the folds largest first, forth and back. A group's place in
    that order (size, then md5 of the group) is its rank among the groups of its
    size and md5 prefix plus a small table of offsets, so no task sorts all groups.
    """
    if k < 2:
        raise ValueError(f"cannot make {k} folds")
    md5 = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in group_columns]))
    sizes = df.groupBy(*group_columns).agg(F.count(F.lit(1)).alias("_n")).withColumn("_md5", md5).withColumn("_prefix", F.substring("_md5", 1, 2))
    before = Window.orderBy(F.col("_n").desc(), "_prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sizes.groupBy("_n", "_prefix").agg(F.count(F.lit(1)).alias("_groups"))            # 256 rows per size at most
               .select("_n", "_prefix", F.coalesce(F.sum("_groups").over(before), F.lit(0)).alias("_from")))
    own = F.row_number().over(Window.partitionBy("_n", "_prefix").orderBy("_md5", *group_columns)) - 1
    place = F.col("_from") + F.col("_own")
    turn = F.pmod(place, F.lit(k))
    dealt = (sizes.withColumn("_own", own).join(offsets, ["_n", "_prefix"])
             .select(*[F.col(c).alias(f"_g_{c}") for c in group_columns],
                     F.when(F.floor(place / k) % 2 == 0, turn).otherwise(k - 1 - turn).cast("int").alias(column)))
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group_columns]
    return df.join(dealt, reduce(lambda a, b: a & b, same)).drop(*[f"_g_{c}" for c in group_columns])


def fold(df: DataFrame, i: int, column: str = "block") -> tuple[DataFrame, DataFrame]:
    """(train, test) of expanding fold ``i`` (1-based)."""
    return df.where(F.col(column) < i), df.where(F.col(column) == i)


def k_folds(df: DataFrame, order_columns: list[str], k: int = N_SPLITS, column: str = "fold") -> DataFrame:
    """Contiguous, unshuffled folds; the first n % k folds get one extra row."""
    def bounds(n):
        if k < 2 or k > n:
            raise ValueError(f"cannot make {k} folds of {n} rows")
        sizes = [n // k + (1 if i < n % k else 0) for i in range(k)]
        return [sum(sizes[:i + 1]) for i in range(k - 1)]

    return with_buckets(df, order_columns, bounds, column)
