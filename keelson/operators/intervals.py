"""Validity intervals (M5, S7, M8, M10): a change table folded once into rows with a life span.

``(key..., payload..., valid_from, valid_to)``: the row is the key's state from version
``valid_from`` up to but without ``valid_to``; a row that still holds has ``valid_to = OPEN``. The state
at a version is then a range filter on two bare columns that reaches the scan, without any aggregate,
and the rows of all versions are a difference array. New commits are folded in without
reading the closed rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keelson.operators.joins import BROADCAST_MAX_ROWS, checked_broadcast
from keelson.operators.keyed import latest_by_key
from keelson.operators.ordered import running_sum
from keelson.sources import sinks

# Of rows that still hold: beyond every version.
OPEN = (1 << 63) - 1
LIFE = ("valid_from", "valid_to")


def fold(changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ("seq",)) -> DataFrame:
    """The intervals of a change table with ``version``, ``op`` and the ``order`` of changes within a
    version.

    A version's last change of a key decides (an aggregate: many changes of one key in one commit
    are combined map-side). The next version that touches the key ends the interval; a delete only
    ends one. The window by key sees one row a version. Keys are compared null-safely."""
    keys = list(keys)
    last = latest_by_key(changes, [*keys, "version"], list(order))
    w = Window.partitionBy(*keys).orderBy("version")
    life = last.withColumn("valid_to", F.coalesce(F.lead("version").over(w), F.lit(OPEN)))
    return (life.filter(F.col("op") != "delete").withColumnRenamed("version", "valid_from")
                .drop("op", *order))


def fold_in(intervals: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ("seq",),
            broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``intervals`` after more commits, all of later versions than those folded so far.

    Only open rows can change: those of a touched key end at its first new version. Closed rows
    stream through. The first versions of the touched keys are broadcast if they are few."""
    keys = list(keys)
    fresh = fold(changes, keys, order)
    first = changes.groupBy(*keys).agg(F.min("version").alias("__first")).withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(keys)})
    first = checked_broadcast(first, broadcast_max_rows)
    is_open = F.col("valid_to") == OPEN
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    touched = (intervals.filter(is_open).join(first, same, "left")
               .withColumn("valid_to", F.coalesce("__first", "valid_to")).select(*intervals.columns))
    return intervals.filter(~is_open).unionByName(touched).unionByName(fresh.select(*intervals.columns))


def write(intervals: DataFrame, path: str) -> None:
    """The intervals as a table: open rows in a folder of their own, which is all that a reader of the
    latest state scans."""
    sinks.write_partitioned(intervals.withColumn("is_open", (F.col("valid_to") == OPEN).cast("int")), path, ["is_open"])


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def state_at(intervals: DataFrame, version: int | None = None) -> DataFrame:
    """The rows that hold at ``version`` (``None``: now), with ``version`` that of their change: equal to
    ``versions.as_of`` on the change table. Only filters: no aggregate, no shuffle."""
    if version is None:
        held = intervals.filter(F.col("valid_to") == OPEN)
        if "is_open" in intervals.columns:
            held = held.filter(F.col("is_open") == 1)
    else:
        held = intervals.filter((F.col("valid_from") <= F.lit(version)) & (F.col("valid_to") > F.lit(version)))
    return held.withColumnRenamed("valid_from", "version").drop("valid_to", "is_open")


def held_between(intervals: DataFrame, first: int, last: int) -> DataFrame:
    """The intervals that hold at any version from ``first`` to ``last``."""
    return intervals.filter((F.col("valid_from") <= F.lit(last)) & (F.col("valid_to") > F.lit(first)))


def live_rows(intervals: DataFrame, versions: DataFrame) -> DataFrame:
    """(version, live_rows) after each of ``versions`` (M10): plus one where an interval begins, minus
    one where it ends, summed up in version order. Both ends are counted in one pass; ``versions`` (one
    column) also names commits after which no interval begins or ends."""
    ends = intervals.select(F.explode(F.array(
        F.struct(F.col("valid_from").alias("version"), F.lit(1).alias("delta")),
        F.struct(F.col("valid_to").alias("version"), F.lit(-1).alias("delta")))).alias("x")).select("x.*")
    named = versions.select(F.col(versions.columns[0]).alias("version"), F.lit(0).alias("delta"))
    deltas = (ends.filter(F.col("version") != OPEN).unionByName(named).groupBy("version")
              .agg(F.sum("delta").cast("bigint").alias("delta"), F.max((F.col("delta") == 0).cast("int")).alias("asked")))
    total = running_sum(deltas, ["version"], "delta", name="live_rows")
    return total.filter(F.col("asked") == 1).select("version", "live_rows")
