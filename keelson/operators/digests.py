"""Snapshot differences by hierarchical digests (M9).

A snapshot is written with the digests of its key ranges: how many rows a range has and two 64-bit
hashes over all of them, in no order. Two snapshots are compared by the digests of their coarse ranges,
then by those of the fine ranges within coarse ones that differ; rows are only read, and joined, where a
fine range differs. What is unchanged costs one row a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators.versions import snapshot_diff
from keelson.sources import sinks

WIDTH, FINE = 1 << 16, 64
COARSE, SMALL = "__coarse", "__fine"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def ranges(df: DataFrame, keys: Sequence[str], width: int = WIDTH, fine: int = FINE) -> tuple[Column, Column]:
    """(coarse, fine) range of a row: of one whole-number key, ``width`` neighbouring values and a
    ``fine``-th of them, so that changes to neighbours stay together; of other keys, the same over a
    32-bit hash. Null keys have a range of their own. The same for every snapshot of a table."""
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, _WHOLE):
        number = F.col(keys[0]).cast("long")
    else:
        number = F.shiftrightunsigned(F.xxhash64(*[F.col(k) for k in keys]), 32)
        width = max(width, 1 << 22)                               # 1,024 coarse ranges at most
    coarse = F.coalesce(F.floor((number - F.pmod(number, F.lit(width))) / width), F.lit(-(1 << 62)))
    return coarse.cast("long"), F.coalesce(F.floor(F.pmod(number, F.lit(width)) * fine / width), F.lit(0)).cast("int")


def digests(df: DataFrame, compare: Sequence[str]) -> DataFrame:
    """(coarse, fine, rows, one, two) of every fine range of a frame with its range columns. Sums up
    map-side; rows differ by their keys, so equal rows cannot cancel each other out."""
    cols = [F.struct(F.col(c).isNull(), F.col(c)) for c in compare]
    return df.groupBy(COARSE, SMALL).agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64(*cols)).alias("one"),
                                         F.bit_xor(F.xxhash64(F.lit(7), *cols)).alias("two"))


def coarse_digests(fine: DataFrame) -> DataFrame:
    """The level above: folded from the fine digests."""
    return fine.groupBy(COARSE).agg(F.sum("rows").alias("rows"), F.bit_xor(F.xxhash64(SMALL, "rows", "one")).alias("one"),
                                    F.bit_xor(F.xxhash64(F.lit(7), SMALL, "rows", "two")).alias("two"))


def write_snapshot(df: DataFrame, keys: Sequence[str], path: str, compare: Sequence[str] | None = None,
                   width: int = WIDTH, fine: int = FINE) -> None:
    """``df`` (unique keys) under ``path``/rows, one folder a coarse range, with the digests of
    ``compare`` (default: all columns) in ``path``/coarse and ``path``/fine."""
    path = path.rstrip("/")
    coarse, small = ranges(df, keys, width, fine)
    sinks.write_partitioned(df.withColumns({COARSE: coarse, SMALL: small}), f"{path}/rows", [COARSE])
    stored = read_rows(df.sparkSession, path)
    digests(stored, list(dict.fromkeys([*keys, *(compare or df.columns)]))).write.mode("overwrite").parquet(f"{path}/fine")
    coarse_digests(df.sparkSession.read.parquet(f"{path}/fine")).write.mode("overwrite").parquet(f"{path}/coarse")


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """A snapshot's rows with their range columns."""
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    return rows.withColumn(COARSE, F.col(COARSE).cast("long"))


def differing(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The ranges (``keys``) whose digests differ or that only one side has."""
    left, right = (d.select(*keys, F.struct("rows", "one", "two").alias(n)) for d, n in ((a, "x"), (b, "y")))
    return left.join(right, list(keys), "full_outer").filter(~F.col("x").eqNullSafe(F.col("y"))).select(*keys)


def diff_snapshots(spark: SparkSession, before: str, after: str, keys: Sequence[str], compare: Sequence[str] | None = None,
                   most_coarse: int = 10_000) -> DataFrame:
    """``snapshot_diff`` of two written snapshots: keys and ``change`` in added / removed / changed.

    Coarse ranges that differ are named to the scans as partition values (up to ``most_coarse``; beyond
    that, most of the table differs and all of it is read), fine ones by a semi-join with their list,
    which adaptive execution broadcasts if it is small. Ranges that agree are not read."""
    keys = list(keys)
    at = lambda p, level: spark.read.parquet(f"{p.rstrip('/')}/{level}")
    coarse = differing(at(before, "coarse"), at(after, "coarse"), [COARSE]).limit(most_coarse + 1)
    named = [r[0] for r in coarse.collect()]                       # one number a differing coarse range
    few = F.col(COARSE).isin(named) if len(named) <= most_coarse else F.lit(True)
    fine = differing(at(before, "fine").filter(few), at(after, "fine").filter(few), [COARSE, SMALL])
    sides = [read_rows(spark, p.rstrip("/")).filter(few).join(fine, [COARSE, SMALL], "left_semi").drop(COARSE, SMALL)
             for p in (before, after)]
    cols = list(compare) if compare is not None else [c for c in sides[0].columns if c not in keys]
    return snapshot_diff(*sides, keys, cols)
