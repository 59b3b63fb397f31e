"""Joins (J1-J9, X4-X5).

Broadcasting is only done behind a size check: ``fits_broadcast`` counts at most
``max_rows + 1`` rows of the candidate (a bounded probe) and otherwise the join is
left to the planner, where adaptive execution can still switch to a broadcast from
measured shuffle sizes, or split skewed partitions of a sort-merge join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default bounds for a side that may be broadcast: at most this many rows AND at most
# this many estimated bytes (rows x schema row width), whichever is tighter.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

# Estimated bytes per value by type name (variable-width types use a typical size).
_WIDTH = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "date": 4, "float": 4, "long": 8,
          "double": 8, "timestamp": 8, "timestamp_ntz": 8, "string": 32, "binary": 32}


def row_width(df: DataFrame) -> int:
    """Estimated bytes per row from the schema (nested types count 64 bytes)."""
    total = 16                                   # row header / null bits
    for f in df.schema.fields:
        t = f.dataType.typeName()
        total += _WIDTH.get(t, 16 if t.startswith("decimal") else 64)
    return total


_PROVEN: dict[tuple, bool] = {}
_MEMO_MAX_FILES = 1_000


def needs_shuffle(df: DataFrame) -> bool:
    """True when computing ``df`` involves a shuffle exchange (read from its physical
    plan; nothing runs). Broadcast exchanges of small sides do not count."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return any(f"Exchange {p}" in plan for p in ("hashpartitioning", "rangepartitioning",
                                                  "RoundRobinPartitioning", "SinglePartition"))


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                   max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``min(max_rows, max_bytes / row width)`` rows;
    reads at most that many + 1 rows.

    The probe is only run when ``df`` streams from its scans without a shuffle, so
    ``take`` can stop after the first tasks; a candidate that would need a shuffle to
    even be counted (a join or aggregate of large inputs) is "not proven" without
    running anything - the planner and AQE then decide from measured sizes.
    The answer is remembered per (plan, exact input file list): rewriting a table
    produces new file names, so a changed dimension is probed again.
    """
    max_rows = max(0, min(max_rows, max_bytes // row_width(df)))
    key = None
    try:
        files = df._jdf.inputFiles()            # JVM array: its length is read without copying
        if len(files) <= _MEMO_MAX_FILES:       # only small inputs are memoized (lookups)
            key = (df.semanticHash(), tuple(sorted(files)), max_rows)
    except Exception:  # plans without a stable hash or file list are always probed
        key = None
    if key is not None and key in _PROVEN:
        return _PROVEN[key]
    if needs_shuffle(df):
        return False
    # ``take`` scans partitions incrementally and stops once max_rows + 1 rows are
    # seen, so probing a large table by mistake costs one or a few tasks, not a job
    # over every partition; only constant one-column rows reach the driver.
    ok = len(df.select(F.lit(1).alias("x")).take(max_rows + 1)) <= max_rows
    if key is not None:
        _PROVEN[key] = ok
    return ok


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` if its size is proven small (rows and estimated bytes), else
    ``df`` unchanged."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def join_dim(fact: DataFrame, dim: DataFrame, on: Column | str | Sequence[str], how: str = "inner",
             strategy: str = "auto", max_rows: int = BROADCAST_MAX_ROWS, keys: tuple[str, str] | None = None,
             salts: int = 16, min_share: float = 0.01) -> DataFrame:
    """Fact x dimension equi-join (J1, J2) with a strategy.

    ``auto``: no hint, the planner/adaptive execution decide. ``broadcast``: broadcast
    the dimension if ``fits_broadcast`` proves it small, else fall back to ``auto``.
    ``merge``: sort-merge join hint (both sides shuffle on the key). ``salted``: find
    the fact keys holding at least ``min_share`` of the rows and salt only those
    (``keys`` = (fact key, dimension key); inner/left only).
    """
    if strategy == "salted":
        if keys is None:
            raise ValueError("salted strategy needs keys=(fact_key, dim_key)")
        hot = hot_key_rows(fact, keys[0], min_share)
        return salted_join(fact, dim, keys[0], keys[1], max(salts, salts_for(hot)), hot=list(hot), how=how)
    if strategy == "broadcast":
        dim = checked_broadcast(dim, max_rows)
    elif strategy == "merge":
        dim = dim.hint("merge")
    elif strategy != "auto":
        raise ValueError(f"unknown join strategy {strategy!r}")
    return fact.join(dim, on, how)


def weighed(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """``df`` with eight bytes a row that do not compress (a hash of ``cols``, which tell rows apart).

    Adaptive execution goes by compressed bytes. Rows that are alike in all the columns a join keeps
    take next to nothing in a shuffle, so a hot key's partition looks small however many rows it
    holds, and is sorted in one task. With the hash kept through the join its bytes tell its rows,
    and it is split. The hash must be used after the join, or the optimizer drops it."""
    return df.withColumn(name, F.xxhash64(*[F.col(c) for c in cols]))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (J8 / relationships test Q4); the
    parent keys are made DISTINCT (U3) before the anti-join."""
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    return (child.filter(F.col(child_key).isNotNull())
                 .join(p, F.col(child_key) == F.col("__pk"), "left_anti"))


def hot_key_rows(df: DataFrame, key: str, min_share: float = 0.01) -> dict:
    """Keys holding at least ``min_share`` of the rows, with their rows; NULL may be one.

    One pass: keys are counted (combined map side), then all counts are added up next to
    the largest 1 / ``min_share`` of them, and no more keys than that can qualify.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    most = math.ceil(1 / min_share)
    top = counts.orderBy(F.desc("n")).limit(most).select(F.col(key).alias("k"), "n")
    rows = top.withColumn("t", F.lit(None).cast("bigint")).unionByName(
        counts.agg(F.sum("n").alias("t")).select(F.lit(None).cast(df.schema[key].dataType).alias("k"),
                                                 F.lit(None).cast("bigint").alias("n"), "t")).collect()
    total = sum(r["t"] or 0 for r in rows)
    return {r["k"]: r["n"] for r in rows if r["n"] and r["n"] >= max(1, math.ceil(total * min_share))}


def hot_keys(df: DataFrame, key: str, min_share: float = 0.01) -> list:
    """The keys of ``hot_key_rows``."""
    return list(hot_key_rows(df, key, min_share))


def salts_for(hot: dict, task_rows: int = 2_000_000, least: int = 2) -> int:
    """Salts that leave a task about ``task_rows`` rows of the hottest key."""
    return max(least, *(-(-n // task_rows) for n in hot.values())) if hot else 1


def salted_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str, salts: int = 16,
                salt_cols: Sequence[str] | None = None, hot: Sequence | None = None,
                how: str = "inner") -> DataFrame:
    """Salted equi-join for a skewed key (J5, X5; F18 salt from a hash, F19 row
    replication with explode(sequence)).

    Each big-side row gets a salt in [0, salts) from a hash of ``salt_cols`` (a unique
    column set, deterministic across retries, unlike ``rand``); the small side is
    replicated once per salt and the join runs on (key, salt), spreading one hot key
    over ``salts`` tasks. With ``hot`` given, only those keys are salted and only
    their small-side rows replicated; every other key joins with salt 0.
    NULL keys of a left join are spread, too. The join is hinted as a sort-merge join: a
    salted broadcast would only replicate for nothing.
    Inner or left (from the big side) only; the result equals the plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins from the big side")
    cols = list(salt_cols) if salt_cols else big.columns
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salts)).cast("int")
    if hot is not None:
        hot = [k for k in hot if k is not None]
        is_hot_big = F.col(big_key).isNull() | (F.col(big_key).isin(hot) if hot else F.lit(False))
        is_hot_small = F.col(small_key).isin(hot) if hot else F.lit(False)
        b = big.withColumn("__salt", F.when(is_hot_big, salt).otherwise(F.lit(0)))
        s = small.withColumn("__salt", F.explode(
            F.when(is_hot_small, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    else:
        b = big.withColumn("__salt", salt)
        s = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    s = s.withColumnRenamed("__salt", "__salt_s")
    cond = (F.col(big_key) == F.col(small_key)) & (F.col("__salt") == F.col("__salt_s"))
    return b.join(s.hint("merge"), cond, how).drop("__salt", "__salt_s")


def with_hot_key(df: DataFrame, key: str, hot_value, share_pct: int = 90, by: str | None = None) -> DataFrame:
    """Send ``share_pct`` % of rows to ``hot_value`` (P15): the skew fixture.

    Deterministic: the choice comes from ``pmod(by, 100)`` of a numeric column
    ``by`` (spread evenly), not from ``rand``.
    """
    pick = F.pmod(F.col(by or key), F.lit(100)) < share_pct
    hot = F.lit(hot_value).cast(df.schema[key].dataType)
    return df.withColumn(key, F.when(pick, hot).otherwise(F.col(key)))
