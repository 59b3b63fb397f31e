"""Change feeds and late rows over many micro-batches, in any order."""

import random

from pyspark.sql import functions as F

from keelson.operators import versions as V
from keelson.plans import domain
from keelson.session import scratch_path
from keelson.streaming import feeds
from tests.helpers import rows

SCHEMA = "k int, p string, version long, seq long, op string"


def test_feed_ignores_the_order_of_arrival(spark):
    rng = random.Random(2)
    changes = [(rng.randint(0, 9), f"p{i}", i // 8, i, rng.choice(["insert", "update", "delete"])) for i in range(80)]
    rng.shuffle(changes)
    src, table, ck = (scratch_path(spark, x) for x in ("feed_in", "feed", "feed_ck"))
    for start in range(0, 80, 20):                                 # four runs, each picks up where the last one stopped
        spark.createDataFrame(changes[start:start + 20], SCHEMA).repartition(2).write.mode("append").parquet(src)
        feeds.run_change_feed(spark, src, spark.createDataFrame([], SCHEMA).schema, table, ck, ["k"], files_per_trigger=1).awaitTermination()
        seen = spark.createDataFrame(changes[:start + 20], SCHEMA)
        want = V.as_of(seen, ["k"])
        assert rows(feeds.feed_state(spark, table, ["k"]).select(*want.columns)) == rows(want)
    folded = scratch_path(spark, "feed_folded")
    feeds.fold_feed(spark, table, folded, ["k"])
    assert rows(feeds.feed_state(spark, folded, ["k"])) == rows(feeds.feed_state(spark, table, ["k"]))


def test_late_change_loses_and_a_repeated_batch_counts_once(spark):
    src, table, ck = (scratch_path(spark, x) for x in ("late_in", "late", "late_ck"))
    schema = spark.createDataFrame([], SCHEMA).schema
    for part in ([(1, "new", 5, 9, "update"), (2, "gone", 5, 8, "delete")], [(1, "old", 2, 3, "insert"), (2, "old", 1, 1, "insert")]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        feeds.run_change_feed(spark, src, schema, table, ck, ["k"]).awaitTermination()
    assert rows(feeds.feed_state(spark, table, ["k"]).select("k", "p")) == [(1, "new")]
    again = spark.read.parquet(f"{table}/{feeds.BATCH}=0")
    spark.createDataFrame(again.collect(), again.schema).write.mode("overwrite").parquet(f"{table}/{feeds.BATCH}=0")
    assert rows(feeds.feed_state(spark, table, ["k"]).select("k", "p")) == [(1, "new")]


def test_late_rows_become_corrections(spark, sf_dir):
    ev = domain.table(spark, sf_dir, "events")
    src, table, ck = (scratch_path(spark, x) for x in ("win_in", "win", "win_ck"))
    late = F.pmod(F.col("event_id"), F.lit(10)) == 0
    for part in (ev.filter(~late), ev.filter(late)):               # a tenth of all rows comes when every window but the last is closed
        part.coalesce(1).write.mode("append").parquet(src)
        feeds.run_corrected_windows(spark, src, ev.schema, table, ck).awaitTermination()
    fixes = feeds.corrections(spark, table)
    whole = feeds.window_deltas(ev, "ts", "event_type", "value", "1 hour").drop("newest")
    mark = feeds.watermark(spark, table)
    closed = whole.filter(F.col("window_end") <= F.lit(str(mark)).cast("timestamp_ntz"))
    assert rows(feeds.corrected_windows(spark, table)) == rows(closed)
    total = lambda df: df.agg(F.sum("events")).first()[0]
    first = feeds.first_results(spark, table)
    assert total(fixes) + total(first) == ev.count()               # no row is lost
    assert 0 < total(fixes) <= ev.filter(late).count() and {r["batch"] for r in fixes.select("batch").distinct().collect()} == {1}
