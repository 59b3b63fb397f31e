from pyspark.sql import functions as F

from keelson.plans import domain, registry
from keelson.session import scratch_path
from keelson.streaming import jobs as T
from tests.helpers import rows


def test_ingest_stream_is_incremental(spark, sf_dir):
    raw = domain.raw_trips(spark, sf_dir)
    src = scratch_path(spark, "raw_src")
    raw.write.parquet(src)
    out, ck = scratch_path(spark, "bronze"), scratch_path(spark, "ck")
    T.ingest_stream(spark, src, raw.schema, out, ck).awaitTermination()
    assert spark.read.parquet(out).count() == raw.count()
    T.ingest_stream(spark, src, raw.schema, out, ck).awaitTermination()   # nothing new: no duplicates
    assert spark.read.parquet(out).count() == raw.count()


def test_foreach_batch_upsert(spark, sf_dir):
    s = registry.silver(spark, sf_dir)
    src = scratch_path(spark, "silver_src")
    s.repartition(3).write.parquet(src)
    base = scratch_path(spark, "tbl")
    fn = T.upsert_batches(lambda i: f"{base}/v{i}", ["trip_id"], ["_ingested_at"])
    ck = scratch_path(spark, "ck")
    q = (spark.readStream.schema(s.schema).option("maxFilesPerTrigger", 1).parquet(src)
         .writeStream.foreachBatch(fn).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    last = q.lastProgress["batchId"]
    final = spark.read.parquet(fn.latest(last))
    assert rows(final) == rows(s)
    # restart from the checkpoint with one more file: continues from the durable version
    extra = s.orderBy("trip_id").limit(5).withColumn("total_amount", F.col("total_amount") + 1)
    extra.write.mode("append").parquet(src)
    q2 = (spark.readStream.schema(s.schema).option("maxFilesPerTrigger", 1).parquet(src)
          .writeStream.foreachBatch(T.upsert_batches(lambda i: f"{base}/v{i}", ["trip_id"], ["_ingested_at"]))
          .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q2.awaitTermination()
    after = spark.read.parquet(fn.latest(q2.lastProgress["batchId"]))
    assert after.count() == s.count()
    assert after.join(extra.select("trip_id", "total_amount"), ["trip_id", "total_amount"]).count() == 5


def test_watermark_drops_nothing_in_one_batch(spark, sf_dir):
    w = registry.QUERIES["stream_event_windows"](spark, sf_dir)
    ev = domain.table(spark, sf_dir, "events")
    mark = ev.agg(F.max("ts")).first()[0]
    closed = ev.filter(F.col("ts") < F.lit(mark.replace(minute=0, second=0, microsecond=0)) - F.expr("INTERVAL 1 HOUR"))
    assert w.agg(F.sum("events")).first()[0] >= closed.count()


def test_late_rows_behind_watermark_are_dropped(spark, sf_dir):
    import os
    import time

    # Spark filters late rows against the previous batch's watermark, so the late
    # batch comes third: day 20, day 21 (watermark moves), then day 10 (late).
    ev = domain.table(spark, sf_dir, "events")
    src = scratch_path(spark, "late_src").replace("file:", "")
    days = ["2024-01-20", "2024-01-21", "2024-01-10"]
    flat = os.path.join(src, "flat")
    os.makedirs(flat)
    for i, d in enumerate(days):
        part = f"{src}/d{i}"
        ev.filter(F.to_date("ts") == F.lit(d).cast("date")).coalesce(1).write.parquet(part)
        f = [x for x in os.listdir(part) if x.endswith(".parquet")][0]
        os.link(os.path.join(part, f), os.path.join(flat, f"part-{i}.parquet"))
        time.sleep(1.2)                               # the file source reads oldest files first
    out, ck = scratch_path(spark, "late_out"), scratch_path(spark, "late_ck")
    q = (T.windowed_demand(spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(flat))
         .writeStream.format("parquet").outputMode("append").option("path", out)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    dropped = sum((p["stateOperators"][0].get("numRowsDroppedByWatermark") or 0)
                  for p in q.recentProgress if p["stateOperators"])
    # the metric counts rows after the partial aggregation before the state store:
    # one per late (hour window, event type) group of the single late file
    late_groups = (ev.filter(F.to_date("ts") == F.lit(days[2]).cast("date"))
                     .select(F.date_trunc("hour", "ts"), "event_type").distinct().count())
    assert dropped == late_groups > 0
    res = spark.read.parquet(out)
    assert res.filter(F.to_date("window_start") == F.lit(days[2]).cast("date")).count() == 0
    assert res.filter(F.to_date("window_start") == F.lit(days[0]).cast("date")).count() > 0


def test_foreach_batch_partitioned_upsert(spark, sf_dir):
    s = registry.silver(spark, sf_dir)
    src = scratch_path(spark, "silver_src_p")
    s.repartition(3).write.parquet(src)
    table = scratch_path(spark, "silver_tbl")
    fn = T.upsert_batches_partitioned(table, ["trip_id"], ["_ingested_at"], "pickup_month",
                                      scratch_path(spark, "stage"))
    q = (spark.readStream.schema(s.schema).option("maxFilesPerTrigger", 1).parquet(src)
         .writeStream.foreachBatch(fn).option("checkpointLocation", scratch_path(spark, "ck_p"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(table).select(*s.columns)
    assert rows(got) == rows(s)
    fn(s.limit(0), 99)                                  # an empty batch changes nothing
    assert spark.read.parquet(table).count() == s.count()
