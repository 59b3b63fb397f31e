"""Sinks (K1-K11). Writers take a DataFrame and a path; none collects data."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import default_parallelism


def rebuild(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full overwrite (K1), the gold strategy. Never point ``path`` at a table this
    plan reads: write a new directory and switch readers to it."""
    if partition_by:
        clustered(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def clustered(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows dealt by the partition columns for a partitioned write. A rebalance, not a plain
    repartition: adaptive execution merges small values into one task and splits the value
    that holds most rows over several, so files are few and no task grows with one value."""
    return df.hint("rebalance", *[F.col(c) for c in cols])


# Parquet options for large tables that are written and read whole: zstd, and the second page format,
# whose delta encodings store sorted times in little and byte keys in their own length.
COMPACT = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), codec: str | None = None,
           options: dict[str, str] | None = None) -> None:
    """Append (K2). Not idempotent: every re-run adds the rows again (see M16)."""
    w = df.write.mode("append").options(**(options or {}))
    if codec is not None:
        w = w.option("compression", codec)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_partition(df: DataFrame, path: str, column: str, value, check: bool = True) -> None:
    """Replace exactly one partition ``column=value`` and keep the others (K3).

    The partition's own folder is overwritten, so an empty frame empties it and no other
    partition can be touched. With ``check`` the frame is first verified to hold only
    ``value`` (a ``limit(1)`` probe; it reads the frame once more when it is clean).
    Callers that set the column themselves pass ``check=False``. Re-running with the same
    input leaves the table unchanged.
    """
    if check:
        stray = df.filter(~F.col(column).eqNullSafe(F.lit(value))).limit(1)
        if not stray.isEmpty():
            raise ValueError(f"frame holds rows outside partition {column}={value!r}")
    df.drop(column).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{column}={value}")


def write_partitioned(df: DataFrame, path: str, cols: Sequence[str], mode: str = "overwrite") -> None:
    """Hive-style layout by one or more columns (K4, K5), few files per partition value and
    several tasks for a large one."""
    clustered(df, cols).write.mode(mode).partitionBy(*cols).parquet(path)


def write_as(df: DataFrame, path: str, fmt: str = "parquet", codec: str | None = None,
             mode: str = "overwrite") -> None:
    """CSV with header, NDJSON, or Parquet with a codec (K6, K7)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", True)
    if codec is not None:
        w = w.option("compression", codec)
    w.format(fmt).save(path)


def save_named(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite",
               partition_by: Sequence[str] = ()) -> None:
    """Catalog table (K8); with ``path`` it is external (drop keeps the files)."""
    w = df.write.mode(mode).format("parquet")
    if path is not None:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def publish(spark: SparkSession, name: str, path: str) -> None:
    """A written table as the external catalog table ``name`` (K8). A table of that name gives way:
    readers by name see either the old files or the new ones, and no file is touched."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int,
                   sort: bool = True, mode: str = "overwrite") -> None:
    """Catalog table bucketed (and sorted) by ``keys`` at ``path``. Two tables bucketed
    the same way on their join key are joined without shuffling either side, which
    removes the fact-fact exchange (line items x orders on the order key) at scale."""
    w = df.write.mode(mode).format("parquet").option("path", path).bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    w.saveAsTable(name)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once as Parquet under a shared folder and return a reader of it.

    Used when several downstream plans consume the same expensive intermediate (a
    layer and its checks): it is computed once, lineage is cut (a lost executor
    re-reads files instead of recomputing the chain), and later reads get column
    pruning and filter pushdown again. Compressed by zstd: these tables are written and read
    whole, and hashed keys take half the room they take with snappy.
    """
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


# Buckets of a table at most; Spark allows 100,000.
MAX_BUCKETS = 10_000


def buckets_for(spark: SparkSession) -> int:
    """Buckets that go with the session's shuffles: as many as these have partitions or, where that is over
    ``MAX_BUCKETS``, the largest number below it that divides them, so that a partition is in one bucket."""
    n = default_parallelism(spark)
    return next(b for b in range(min(n, MAX_BUCKETS), 0, -1) if n % b == 0)


def materialize_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int,
                         order: Sequence[str] = ()) -> DataFrame:
    """``materialize`` as a table bucketed by ``keys``: two of them with as many buckets are merged or
    joined on the keys without shuffling either. Rows are sorted by ``order`` inside a bucket; where
    columns go with it they take less room.

    Each bucket is one file where ``df`` is dealt by the same hash, that is shuffled by the same keys
    (see ``buckets_for``) or read from such tables, which are scanned by bucket here. From any other frame
    each task writes a file for every bucket it holds rows of. The table's name is of this session only.
    """
    spark = df.sparkSession
    name = f"keelson_{uuid.uuid4().hex[:12]}"
    w = df.write.mode("overwrite").format("parquet").options(path=path, **COMPACT).bucketBy(buckets, *keys)
    # A scan by bucket is else given up where no join asks for it, as that of a merge's source.
    setting = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        (w.sortBy(*order) if order else w).saveAsTable(name)
    finally:
        spark.conf.set(setting, before)
    return spark.table(name)


def run_noop(df: DataFrame) -> None:
    """Compute everything, write nothing (K10): the benchmark sink."""
    df.write.format("noop").mode("overwrite").save()


def preview(df: DataFrame, n: int = 20):
    """Small result to the client (K11): always bounded by ``limit`` first."""
    return df.limit(n).collect()
