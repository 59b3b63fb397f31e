"""Table mutation and versions as DataFrame operators.

No transaction log is written. A versioned table is a *change table*:
``(key..., payload..., version, seq, op)`` with ``op`` in insert/update/delete, where
``version`` is the commit and ``seq`` orders changes inside a commit. A snapshot is a
fold of that table; every fold here is a per-key aggregate (map-side combined), so a
key with a huge change history does not land in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from keelson.functions.columns import count_if
from keelson.operators.joins import BROADCAST_MAX_ROWS, checked_broadcast, fits_broadcast
from keelson.operators.keyed import assert_unique, latest_by_key
from keelson.operators.ordered import running_sum
from keelson.session import path_exists, remove_path

OPS = ("insert", "update", "delete")


def _not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


# ----------------------------------------------------------------------------- merge

def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], check_unique: bool = True,
           broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """MERGE: matched -> replace all columns, not matched -> insert.

    Plain ``=`` semantics: NULL keys never match, so NULL-key source rows are always
    inserted and NULL-key target rows always kept. A duplicate source key raises
    (M2). Plan: target LEFT ANTI source-keys, then UNION source. When the source keys
    are proven small they are broadcast and the target is never shuffled (a 1 %
    change rewrites by streaming the target once); otherwise both sides shuffle on the
    keys and adaptive execution splits skewed key ranges.
    Columns only in the source are added (NULL for old rows), as with schema evolution.
    """
    keys = list(keys)
    if check_unique:
        assert_unique(source, keys)
    src_keys = checked_broadcast(source.select(*keys).filter(_not_null(keys)), broadcast_max_rows)
    kept = target.join(src_keys, keys, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def upsert_partitions(spark, target_path: str, source: DataFrame, keys: Sequence[str], partition_col: str,
                      staging_path: str, broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> list:
    """MERGE into a partitioned Parquet table rewriting only the touched partitions
    (M1 at scale).

    The source is written once to ``staging_path/source``. Touched are the partitions the
    source names and those where the target holds one of its keys (a semi-join that reads
    the target's key columns only), so a key that moves to another partition leaves no copy
    behind. These are read, merged with ``upsert``, written to ``staging_path/merged`` (a
    table is never read and overwritten by one job) and copied over with dynamic partition
    overwrite; a partition that has lost its last row is emptied. Untouched partitions are
    not written. Columns that only the source has are kept (NULL in older rows); read the
    table with merged schemas then. Returns the touched partition values, sorted.

    Before the first partition is replaced, the touched values are written down next to the merged
    rows. A run that stops between there and the end leaves a table that ``finish_upsert``, or the next
    call with the same ``staging_path``, completes from these; use a path per merge otherwise.
    """
    keys = list(keys)
    staging_path = staging_path.rstrip("/")
    finish_upsert(spark, target_path, partition_col, staging_path)
    remove_path(spark, f"{staging_path}/touched")
    remove_path(spark, f"{staging_path}/done")
    source.write.mode("overwrite").parquet(f"{staging_path}/source")
    source = spark.read.parquet(f"{staging_path}/source")
    target = spark.read.option("basePath", target_path).option("mergeSchema", True).parquet(target_path)
    src_keys = checked_broadcast(source.select(*keys).filter(_not_null(keys)), broadcast_max_rows)
    held = target.select(*keys, partition_col).join(src_keys, keys, "left_semi").select(partition_col)
    touched = sorted({r[0] for r in source.select(partition_col).union(held).distinct().collect()},
                     key=lambda v: (v is None, v))
    if not touched:
        return []
    part = target.filter(F.col(partition_col).isin([v for v in touched if v is not None])
                         | (F.col(partition_col).isNull() if None in touched else F.lit(False)))
    merged = upsert(part, source, keys, broadcast_max_rows=broadcast_max_rows)
    merged.write.mode("overwrite").partitionBy(partition_col).parquet(f"{staging_path}/merged")
    value = T.StructType([T.StructField(partition_col, target.schema[partition_col].dataType)])
    empty = merged.limit(0)
    empty.write.mode("overwrite").parquet(f"{staging_path}/schema")
    spark.createDataFrame([(v,) for v in touched], value).write.mode("overwrite").parquet(f"{staging_path}/touched")
    finish_upsert(spark, target_path, partition_col, staging_path)
    return touched


def finish_upsert(spark, target_path: str, partition_col: str, staging_path: str) -> bool:
    """Replace the touched partitions by the merged rows of ``staging_path``, if a merge has got that
    far and not to its end; True if there was something to do. May run any number of times."""
    staging_path = staging_path.rstrip("/")
    if not path_exists(spark, f"{staging_path}/touched/_SUCCESS") or path_exists(spark, f"{staging_path}/done"):
        return False
    touched = [r[0] for r in spark.read.parquet(f"{staging_path}/touched").collect()]
    staged = spark.read.schema(spark.read.parquet(f"{staging_path}/schema").schema).parquet(f"{staging_path}/merged")
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(partition_col).parquet(target_path))
    left = {r[0] for r in staged.select(partition_col).distinct().collect()}
    for value in touched:
        if value not in left:
            staged.limit(0).drop(partition_col).write.mode("overwrite").parquet(
                f"{target_path.rstrip('/')}/{partition_col}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
    staged.limit(0).write.mode("overwrite").parquet(f"{staging_path}/done")
    return True


def upsert_metrics(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """One row: source_rows, updated, inserted, copied (M3), for a target with
    unique keys.

    ``copied`` counts target rows not matched - what a row-level rewrite copies; a
    file-level engine copies only rows sharing a file with a match. When the source
    keys are proven small, target rows are flagged by a broadcast left join (the
    target is streamed once, never shuffled) and both sides are counted in one
    aggregate over a tagged union; otherwise a full outer join on the keys is used.
    """
    keys = list(keys)
    if fits_broadcast(source.select(*keys), broadcast_max_rows):
        sk = F.broadcast(source.select(*keys).filter(_not_null(keys)).withColumn("__s", F.lit(1)))
        t = target.select(*keys).join(sk, keys, "left").select(F.lit(1).alias("__t"), "__s",
                                                               F.lit(None).cast("int").alias("__src"))
        s = source.select(F.lit(None).cast("int").alias("__t"), F.lit(None).cast("int").alias("__s"),
                          F.lit(1).alias("__src"))
        u = t.unionByName(s)
        ts, ss = F.col("__t").isNotNull(), F.col("__s").isNotNull()
        g = u.agg(count_if(F.col("__src").isNotNull()).alias("source_rows"),
                  count_if(ts & ss).alias("updated"), count_if(ts & ~ss).alias("copied"))
        return g.select("source_rows", "updated", (F.col("source_rows") - F.col("updated")).alias("inserted"),
                        "copied")
    t = target.select(*keys).withColumn("__t", F.lit(1))
    s = source.select(*keys).withColumn("__s", F.lit(1))
    cond = None
    for k in keys:
        c = t[k] == s[k]
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    ts, ss = F.col("__t").isNotNull(), F.col("__s").isNotNull()
    return j.agg(count_if(ss).alias("source_rows"),
                 count_if(ts & ss).alias("updated"),
                 count_if(ss & ~ts).alias("inserted"),
                 count_if(ts & ~ss).alias("copied"))


# ----------------------------------------------------------------------------- versions

def as_of(changes: DataFrame, keys: Sequence[str], version: int | None = None,
          order: Sequence[str] = ("version", "seq")) -> DataFrame:
    """Table state at ``version`` inclusive (M5, S7); ``None`` = latest (M8 pins a
    reader by passing its version). Last change per key wins; a delete hides the key
    until a later insert/update; an update of an unseen key acts as an insert.
    Output: keys, payload, ``version`` of the winning change."""
    c = changes if version is None else changes.filter(F.col("version") <= F.lit(version))
    last = latest_by_key(c, keys, list(order))
    return last.filter(F.col("op") != "delete").drop("op", "seq")


def history(changes: DataFrame, ts_col: str | None = None) -> DataFrame:
    """One row per version (M6): change counts by op, and commit time if known."""
    aggs = [F.count(F.lit(1)).alias("n_changes")] + [count_if(F.col("op") == o).alias(f"n_{o}") for o in OPS]
    if ts_col:
        aggs.append(F.max(ts_col).alias("committed_at"))
    return changes.groupBy("version").agg(*aggs)


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str],
                  compare: Sequence[str] | None = None) -> DataFrame:
    """What changed between two snapshots (M9): keys + ``change`` in
    added/removed/changed. Payload columns are compared NULL-safely."""
    keys = list(keys)
    cols = list(compare) if compare is not None else [c for c in before.columns if c not in keys]
    a = before.select(*keys, *[F.col(c).alias(f"__a_{c}") for c in cols], F.lit(1).alias("__a"))
    b = after.select(*keys, *[F.col(c).alias(f"__b_{c}") for c in cols], F.lit(1).alias("__b"))
    j = a.join(b, keys, "full_outer")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"__a_{c}").eqNullSafe(F.col(f"__b_{c}"))
    change = (F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed")
               .when(~same, "changed"))
    return j.select(*keys, change.alias("change")).filter(F.col("change").isNotNull())


def changes_to(changes: DataFrame, keys: Sequence[str], state: DataFrame, payload: Sequence[str]) -> DataFrame:
    """Change rows of a new version (max + 1) that turn the latest state into ``state``:
    delete keys ``state`` lacks, insert new keys, update changed payloads. Keys and
    payloads are compared NULL-safely; unchanged rows produce no change row."""
    keys, payload = list(keys), list(payload)
    cur = as_of(changes, keys).select(*keys, *[F.col(p).alias(f"__c_{p}") for p in payload], F.lit(1).alias("__c"))
    old = state.select(*keys, *payload, F.lit(1).alias("__o"))
    j = cur.join(old, keys, "full_outer")
    same = F.lit(True)
    for p in payload:
        same = same & F.col(p).eqNullSafe(F.col(f"__c_{p}"))
    op = (F.when(F.col("__o").isNull(), "delete").when(F.col("__c").isNull(), "insert")
           .when(~same, "update"))
    nxt = changes.agg(F.max("version")).first()[0]   # one scalar: the new version number
    nxt = 0 if nxt is None else nxt + 1
    return (j.withColumn("op", op).filter(F.col("op").isNotNull())
             .select(*keys, *payload, F.lit(nxt).cast("bigint").alias("version"),
                     F.lit(0).cast("bigint").alias("seq"), "op"))


def restore(changes: DataFrame, keys: Sequence[str], version: int, payload: Sequence[str]) -> DataFrame:
    """Change rows of a new version (max + 1) that bring the latest state back to
    ``version`` (M7). Append them to ``changes``: history only grows, and
    ``as_of(changes + restore)`` equals ``as_of(changes, version)``."""
    return changes_to(changes, keys, as_of(changes, keys, version), payload)


def overwrite(changes: DataFrame, keys: Sequence[str], rows: DataFrame, payload: Sequence[str]) -> DataFrame:
    """A whole-table overwrite recorded as a new version (§2.10): keys missing from
    ``rows`` are deleted, the others inserted or updated. Earlier versions stay
    readable with ``as_of``. ``rows`` must have unique keys."""
    assert_unique(rows, keys)
    return changes_to(changes, keys, rows, payload)


def rows_by_version(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Live row count after every version.

    Per (key, version) the last op decides whether the key is live after that
    version (aggregate, skew-safe). The previous state of a key comes from a lag over
    that key's *versions* - at most one row per version, however many changes a hot
    key has. Signed deltas are summed per version and accumulated in version order by
    the distributed ``running_sum``.
    """
    keys = list(keys)
    per_kv = latest_by_key(changes.select(*keys, "version", "seq", "op"), keys + ["version"], ["seq"])
    alive = (F.col("op") != "delete").cast("int")
    w = Window.partitionBy(*keys).orderBy("version")
    d = (per_kv.withColumn("__alive", alive)
               .withColumn("__delta", F.col("__alive") - F.coalesce(F.lag("__alive").over(w), F.lit(0))))
    per_v = d.groupBy("version").agg(F.sum("__delta").cast("bigint").alias("delta"))
    return running_sum(per_v, ["version"], "delta", name="live_rows").select("version", "live_rows")


# ----------------------------------------------------------------------------- schema

def check_schema(df: DataFrame, target: T.StructType, evolve: bool = False) -> T.StructType:
    """Write-time schema enforcement (M14). Extra columns are rejected unless
    ``evolve``; a column whose type differs is always rejected. Returns the schema
    after the write (target + new columns)."""
    tgt = {f.name: f.dataType for f in target.fields}
    extra = [f for f in df.schema.fields if f.name not in tgt]
    bad = [f.name for f in df.schema.fields if f.name in tgt and f.dataType != tgt[f.name]]
    if bad:
        raise ValueError(f"type mismatch for columns {bad}")
    if extra and not evolve:
        raise ValueError(f"unexpected columns {[f.name for f in extra]}; enable schema evolution to add them")
    return T.StructType(list(target.fields) + [T.StructField(f.name, f.dataType, True) for f in extra])


def union_evolving(a: DataFrame, b: DataFrame) -> DataFrame:
    """Append with schema evolution (U2, M15): missing columns read as NULL."""
    return a.unionByName(b, allowMissingColumns=True)


def rerun_growth(batch: DataFrame, keys: Sequence[str], runs: int = 3) -> DataFrame:
    """Idempotency contrast (M16): rows after ``runs`` re-runs of the same batch as an
    append vs as an upsert. Output: strategy, runs, rows."""
    appended = batch
    merged = batch
    for _ in range(runs - 1):
        appended = appended.unionByName(batch)
        merged = upsert(merged, batch, keys, check_unique=False)
    return (appended.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("append").alias("strategy"), "rows")
            .unionByName(merged.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("upsert").alias("strategy"), "rows"))
            .withColumn("runs", F.lit(runs)))
