"""Operators that need a global order, without a single-task window.

``row_number() over (order by x)`` with no partition runs in one task. Here the data
is range partitioned on the order (balanced by sampling, and a heavy key is split
across partitions because the range includes the tie-breaking columns), each
partition is sorted locally, and only one number per partition - its row count - goes
to the driver to build the prefix offsets. That list is bounded by the partition
count, not by the data.

The range-partitioned frame is checkpointed to the shared checkpoint folder so the
counting pass and the numbering pass see identical partitions, even after an
executor loss (a re-sampled range partitioner could otherwise move rows).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators.ranks import ENOUGH, locate, typed
from keelson.session import default_parallelism, ensure_checkpoint_dir

_PID = "__pid"
_MONO = "__mono"


def _cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def range_partitioned(df: DataFrame, order: Sequence[str | Column], partitions: int | None = None,
                      checkpoint: bool = True) -> DataFrame:
    """Range partition + local sort on ``order``; optionally cut lineage."""
    n = partitions or default_parallelism(df.sparkSession)
    ranged = df.repartitionByRange(n, *_cols(order)).sortWithinPartitions(*_cols(order))
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        ranged = ranged.checkpoint(eager=True)
    return ranged


def _partition_starts(tagged: DataFrame, weight: Column | None = None) -> list[int]:
    """Prefix offset of every partition (one count per partition reaches the driver)."""
    agg = F.count(F.lit(1)) if weight is None else F.sum(weight)
    rows = tagged.groupBy(_PID).agg(agg.alias("n")).collect()  # <= partition count rows
    sizes = [0] * (max([r[_PID] for r in rows], default=0) + 1)
    for r in rows:
        sizes[r[_PID]] = r["n"] or 0
    return [0] + list(accumulate(sizes))[:-1]


def sequential_id(df: DataFrame, order: Sequence[str | Column], name: str = "seq_id", offset: int = 0,
                  partitions: int | None = None, checkpoint: bool = True) -> DataFrame:
    """Dense 1-based numbering in ``order`` plus ``offset``.

    Equals ``row_number() over (order by order) + offset`` when ``order`` is unique.
    """
    ranged = range_partitioned(df, order, partitions, checkpoint)
    tagged = ranged.withColumn(_PID, F.spark_partition_id()).withColumn(_MONO, F.monotonically_increasing_id())
    starts = _partition_starts(tagged)
    # One row per partition: bounded by construction, so it is broadcast; the join
    # streams the big side and keeps its partitioning and order.
    offs = df.sparkSession.createDataFrame([(i, s) for i, s in enumerate(starts)], f"{_PID} int, __start long")
    local = F.col(_MONO) - F.shiftleft(F.col(_PID).cast("bigint"), 33)
    return (tagged.join(F.broadcast(offs), _PID)
                  .withColumn(name, F.col("__start") + local + 1 + F.lit(offset))
                  .drop(_PID, _MONO, "__start"))


def running_sum(df: DataFrame, order: Sequence[str], value: str, name: str = "running",
                partitions: int | None = None) -> DataFrame:
    """Cumulative ``sum(value)`` in a unique ``order`` (rows frame; NULL counts as 0).

    Single numeric order column: every row gets the quantile bucket of that value
    (bounds from a bounded ``approxQuantile`` sketch, so the assignment is a pure
    function of the value and identical on any retry), rows are hash-partitioned by
    bucket, one total per bucket reaches the driver for the prefix offsets, and a
    window partitioned by bucket - already satisfied by that partitioning, so no
    further shuffle - adds the running sum inside each bucket. Everything stays in
    the JVM. Other order types use range partitions, a checkpoint and an Arrow
    batch pass per partition.
    """
    from pyspark.sql.window import Window

    from keelson.operators.layout import _bucket
    # The buckets are a comparison tree in the plan: bounded, whatever the partition count.
    n = min(partitions or default_parallelism(df.sparkSession), 64)
    first = order[0]
    # Single numeric order column (unique by contract, so no bucket can hold a heavy
    # value): JVM bucket path. Composite orders use range partitions, which split a
    # heavy leading value across partitions by the tie-breaking columns.
    if len(order) == 1 and isinstance(df.schema[first].dataType, T.NumericType):
        qs = [i / n for i in range(1, n)]
        splits = sorted({v for v in df.approxQuantile(first, qs, 0.001) if v is not None})
        b = df.withColumn("__b", _bucket(first, splits)).repartition(n, "__b")
        v = F.coalesce(F.col(value).cast("bigint"), F.lit(0).cast("bigint"))
        totals = {r["__b"]: r["t"] or 0 for r in b.groupBy("__b").agg(F.sum(v).alias("t")).collect()}  # <= n rows
        acc, offs = 0, []
        for k in range(len(splits) + 1):
            offs.append((k, acc))
            acc += totals.get(k, 0)
        offsets = df.sparkSession.createDataFrame(offs, "__b int, __start long")
        w = Window.partitionBy("__b").orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, 0)
        return (b.join(F.broadcast(offsets), "__b")
                 .withColumn(name, F.col("__start") + F.sum(v).over(w)).drop("__b", "__start"))
    ranged = range_partitioned(df, order, partitions, True)
    tagged = ranged.withColumn(_PID, F.spark_partition_id())
    starts = _partition_starts(tagged, F.col(value))          # shipped with the task closure
    out_schema = T.StructType(list(tagged.schema.fields) + [T.StructField(name, T.LongType())])

    def local_cumsum(batches):
        carry = None
        for pdf in batches:
            if pdf.empty:
                continue
            if carry is None:
                carry = int(starts[int(pdf[_PID].iloc[0])])
            cs = pdf[value].fillna(0).astype("int64").cumsum() + carry
            carry = int(cs.iloc[-1])
            pdf[name] = cs
            yield pdf

    return tagged.mapInPandas(local_cumsum, out_schema).drop(_PID)


def row_ids(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Arbitrary unique 64-bit ids (W3, ``row_number() over ()``): no shuffle, no
    order; ids are increasing per partition but NOT dense. Use ``sequential_id`` for
    dense, ordered numbers."""
    return df.withColumn(name, F.monotonically_increasing_id())


def batch_slice(df: DataFrame, order: Sequence[str], n: int, offset: int, enough: int = ENOUGH) -> DataFrame:
    """``order by ... limit n offset m`` (O5) of a unique ascending order, nulls first, without sorting
    or writing the table.

    ``ranks.locate`` counts its way to the two regions that hold ranks ``m + 1`` and ``m + n``; only
    rows from the first to the second are read again. Up to ``enough`` rows more than ``n`` are left, and
    these alone are ordered: by a bounded sort for a small batch, otherwise by ``sequential_id``. Where
    rows agree in all order columns, any of them may stand at the batch's ends."""
    first, last = locate(df, order, [offset + 1, offset + n], enough)
    if n <= 0 or not first.rows:
        return df.limit(0)
    columns = typed(df, order)
    rest = df.filter(first.onwards(columns))
    if last.rows:
        rest = rest.filter(last.upto(columns))
    skip, ascending = offset - first.before, [F.col(c).asc_nulls_first() for c in order]
    if skip + n <= 2 * enough:
        return rest.orderBy(*ascending).limit(skip + n).offset(skip)
    return sequential_id(rest, ascending, "__seq").filter(
        (F.col("__seq") > skip) & (F.col("__seq") <= skip + n)).drop("__seq")


def top_groups(df: DataFrame, key: str, k: int, count_name: str = "trips",
               extra: dict[str, Column] | None = None) -> DataFrame:
    """Top-k groups by row count with a key tie-break (O3), plus optional ``extra``
    aggregates (name -> aggregate column). Counting combines map side; only the k
    best rows per task reach the final sort."""
    aggs = [F.count(F.lit(1)).alias(count_name)] + [v.alias(n) for n, v in (extra or {}).items()]
    return df.groupBy(key).agg(*aggs).orderBy(F.desc(count_name), F.asc(key)).limit(k)
