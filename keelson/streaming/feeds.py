"""Change feeds and late data.

Both keep what they have seen in tables of one folder a micro-batch, written with overwrite: a batch
that runs again after a failure replaces its own folder, so every change counts once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from keelson.functions.columns import cents, instant_from_ntz, ntz_from_instant
from keelson.operators.keyed import latest_by_key

BATCH = "__batch"


def _folder(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/{BATCH}={batch_id}"


def _stored(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.option("basePath", root).option("mergeSchema", True).parquet(f"{root.rstrip('/')}/*")


# ---- change feeds ----------------------------------------------------------------------------


def winners(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of a stream of changes, each key's change of the highest ``order`` so far (T3). As a streaming
    aggregate the winner is the key's state: a change that arrives late, after one of a higher
    sequence number, loses against it and is not emitted again as new; a delete stays in the state,
    so that an older insert cannot bring the key back."""
    return latest_by_key(changes, keys, order)


def run_change_feed(spark: SparkSession, source_dir: str, schema: T.StructType, table: str, checkpoint: str,
                    keys: Sequence[str], order: Sequence[str] = ("version", "seq"),
                    files_per_trigger: int | None = None) -> StreamingQuery:
    """Fold change files (in any order, over any number of micro-batches) into ``table``. Each
    micro-batch adds the keys it has changed with their winners, deletes included."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_folder(table, batch_id))

    return (winners(reader.parquet(source_dir), keys, order).writeStream.outputMode("update").foreachBatch(put)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def feed_state(spark: SparkSession, table: str, keys: Sequence[str], order: Sequence[str] = ("version", "seq")) -> DataFrame:
    """The table that the feed describes: each key's last winner, without deleted keys."""
    last = latest_by_key(_stored(spark, table).drop(BATCH), keys, order)
    return last.filter(F.col("op") != "delete").drop("op", "seq")


def fold_feed(spark: SparkSession, table: str, folded: str, keys: Sequence[str], order: Sequence[str] = ("version", "seq")) -> None:
    """Compaction of a feed's table: one row a key (deletes stay) as batch 0 of a new one; later
    batches go on there. Readers switch over when it is complete."""
    latest_by_key(_stored(spark, table).drop(BATCH), keys, order).write.mode("overwrite").parquet(_folder(folded, 0))


# ---- windows with corrections ------------------------------------------------------------------


def window_deltas(rows: DataFrame, ts_col: str, group_col: str, value_col: str, window: str) -> DataFrame:
    """Events and cents a window and group, with the newest event time of each."""
    s = rows.filter(F.col(ts_col).isNotNull()).withColumn("__ts", instant_from_ntz(ts_col))
    g = s.groupBy(F.window("__ts", window).alias("w"), F.col(group_col)).agg(
        F.count(F.lit(1)).alias("events"), F.sum(cents(value_col)).alias("value_cents"), F.max(ts_col).alias("newest"))
    return g.select(ntz_from_instant("w.start").alias("window_start"), ntz_from_instant("w.end").alias("window_end"),
                    group_col, "events", "value_cents", "newest")


def run_corrected_windows(spark: SparkSession, source_dir: str, schema: T.StructType, table: str, checkpoint: str,
                          ts_col: str = "ts", group_col: str = "event_type", value_col: str = "value", window: str = "1 hour",
                          delay: str = "1 hour", files_per_trigger: int | None = None) -> StreamingQuery:
    """Windowed demand that loses no late row (T2). Every micro-batch is aggregated by window and
    stored; rows of windows that the watermark had closed before the batch (newest event of the
    earlier batches less ``delay``) are marked as late. Nothing is held in memory between batches,
    so state does not grow with the number of open windows, and a window may be corrected however
    late its rows come. The rows of a batch are summed before anything is stored."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def put(batch: DataFrame, batch_id: int) -> None:
        deltas = window_deltas(batch, ts_col, group_col, value_col, window)
        mark = None
        if batch_id:
            mark = watermark(batch.sparkSession, table, delay, before=batch_id)
        late = F.lit(False) if mark is None else F.col("window_end") <= F.lit(str(mark)).cast("timestamp_ntz")
        deltas.withColumn("late", late).write.mode("overwrite").parquet(_folder(table, batch_id))

    return (reader.parquet(source_dir).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def watermark(spark: SparkSession, table: str, delay: str = "1 hour", before: int | None = None):
    """The newest event time of the batches (``before`` one of them) less ``delay``; one value."""
    stored = _stored(spark, table)
    if before is not None:
        stored = stored.filter(F.col(BATCH) < before)
    return stored.agg((F.max("newest") - F.expr(f"INTERVAL {delay}")).alias("m")).first()["m"]


def _summed(deltas: DataFrame, group_col: str) -> DataFrame:
    return deltas.groupBy("window_start", "window_end", group_col).agg(
        F.sum("events").alias("events"), F.sum("value_cents").alias("value_cents"))


def first_results(spark: SparkSession, table: str, group_col: str = "event_type") -> DataFrame:
    """What had been counted of each window when it closed: a watermarked aggregate's result."""
    return _summed(_stored(spark, table).filter(~F.col("late")), group_col)


def corrections(spark: SparkSession, table: str, group_col: str = "event_type") -> DataFrame:
    """One row a closed window, group and batch with late rows: events and cents to be added."""
    return _stored(spark, table).filter("late").select(
        "window_start", "window_end", group_col, "events", "value_cents", F.col(BATCH).cast("long").alias("batch"))


def corrected_windows(spark: SparkSession, table: str, group_col: str = "event_type", delay: str = "1 hour") -> DataFrame:
    """Every window that the watermark has closed by now, first results and corrections summed: what
    a batch aggregate over all rows gives."""
    mark = watermark(spark, table, delay)
    total = _summed(_stored(spark, table), group_col)
    return total.limit(0) if mark is None else total.filter(F.col("window_end") <= F.lit(str(mark)).cast("timestamp_ntz"))
