"""Structured Streaming extension.

The batch pipeline has an incremental half; these jobs express it with Structured
Streaming: a file stream into bronze, a watermarked windowed aggregate, and a
per-micro-batch upsert. All state and progress live in checkpoint folders under the
shared checkpoint directory, so a restarted job resumes exactly where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from keelson.functions.columns import cents, instant_from_ntz, ntz_from_instant
from keelson.operators.keyed import dedup_first
from keelson.operators.versions import upsert, upsert_partitions
from keelson.plans.medallion import month_label
from keelson.session import path_exists


def ingest_stream(spark: SparkSession, source_dir: str, schema: T.StructType, bronze_path: str,
                  checkpoint: str, pickup_col: str = "tpep_pickup_datetime",
                  files_per_trigger: int | None = None) -> StreamingQuery:
    """Incremental file ingest into bronze (T1): each new Parquet file is read once,
    stamped with file name / ingest time / month and appended, partitioned by month.
    ``availableNow`` processes what is there and stops (a scheduled incremental run)."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    s = reader.parquet(source_dir)
    out = (s.withColumn("_source_file", F.col("_metadata.file_name"))
             .withColumn("_ingested_at", F.current_timestamp().cast("timestamp_ntz"))
             .withColumn("_pickup_month", month_label(pickup_col)))
    return (out.writeStream.format("parquet").option("path", bronze_path)
               .option("checkpointLocation", checkpoint).partitionBy("_pickup_month")
               .trigger(availableNow=True).start())


def windowed_demand(stream: DataFrame, ts_col: str = "ts", group_col: str = "event_type",
                    value_col: str = "value", window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Hourly demand with a watermark (T2): events, value in cents per window and
    group. Rows later than ``delay`` behind the newest event are dropped, and in
    append mode a window is emitted once the watermark passes its end. State per
    window is bounded by the watermark."""
    s = stream.withColumn("__ts", instant_from_ntz(ts_col)).withWatermark("__ts", delay)
    g = s.groupBy(F.window("__ts", window).alias("w"), F.col(group_col)).agg(
        F.count(F.lit(1)).alias("events"), F.sum(cents(value_col)).alias("value_cents"))
    return g.select(ntz_from_instant("w.start").alias("window_start"),
                    ntz_from_instant("w.end").alias("window_end"),
                    group_col, "events", "value_cents")


def run_windowed_demand(spark: SparkSession, source_dir: str, schema: T.StructType, out_path: str,
                        checkpoint: str, **kw) -> StreamingQuery:
    """Start T2 over a Parquet directory, appending closed windows to ``out_path``."""
    s = spark.readStream.schema(schema).parquet(source_dir)
    return (windowed_demand(s, **kw).writeStream.format("parquet").outputMode("append")
            .option("path", out_path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def upsert_batches(target_path_of: Callable[[int], str], keys: Sequence[str], order: Sequence[str],
                   initial: str | None = None):
    """foreachBatch function for a per-micro-batch upsert.

    Each batch is deduplicated by key (first by ``order``) and upserted into the
    version written by the previous batch, ``target_path_of(batch_id - 1)`` (or
    ``initial`` for batch 0); the result goes to a *new* directory
    ``target_path_of(batch_id)``, so a table is never overwritten while being read.
    No state is kept in the driver: a query restarted from its checkpoint continues
    from the durable previous version, and a re-run batch id rewrites the same
    directory with the same rows. ``fn.latest(batch_id)`` names a batch's table.
    """

    def previous(batch_id: int) -> str | None:
        return initial if batch_id == 0 else target_path_of(batch_id - 1)

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        src = dedup_first(batch, keys, order)
        prev = previous(batch_id)
        out = src if prev is None else upsert(spark.read.parquet(prev), src, keys, check_unique=False)
        out.write.mode("overwrite").parquet(target_path_of(batch_id))

    fn.latest = target_path_of
    return fn


def upsert_batches_partitioned(table_path: str, keys: Sequence[str], order: Sequence[str], partition_col: str,
                               staging_root: str):
    """foreachBatch function for a per-micro-batch upsert into ONE partitioned table
    (T3 at scale): each batch is deduplicated by key and merged with
    ``upsert_partitions``, so only the partitions the batch touches are read and
    rewritten. Replaying a batch id applies the same upsert again (idempotent)."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        src = dedup_first(batch, keys, order)
        if path_exists(spark, table_path):
            upsert_partitions(spark, table_path, src, keys, partition_col, f"{staging_root.rstrip('/')}/batch={batch_id}")
        else:
            src.write.mode("overwrite").partitionBy(partition_col).parquet(table_path)

    return fn
