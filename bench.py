"""Benchmark: headline queries on local[$BENCH_CPUS] at $BENCH_SF_DIR.

Each query runs to a no-op sink (full compute, no output I/O): one warm-up, then the
minimum of three timed runs. Prints ONE JSON line:
{"metric": ..., "value": total seconds, "unit": "sec", "queries": {...}, "sf": ...}
Layout variants also report how many files a narrow predicate must read.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from keelson.operators import joins as J  # noqa: E402
from keelson.operators import layout as L  # noqa: E402
from keelson.operators import versions as Vr  # noqa: E402
from keelson.plans import domain, gold, registry  # noqa: E402
from keelson.session import build_session, scratch_path  # noqa: E402
from keelson.sources import sinks  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def timed(build, runs=RUNS):
    sinks.run_noop(build())            # warm-up (also primes file listing and JIT)
    best = float("inf")
    for _ in range(runs):
        t0 = time.perf_counter()
        sinks.run_noop(build())
        best = min(best, time.perf_counter() - t0)
    return round(best, 3)


def main():
    spark = build_session(f"local[{CPUS}]", "keelson-bench", shuffle_partitions=max(8, 2 * CPUS),
                          extra={"spark.driver.memory": "16g"})
    sf = SF_DIR
    q = {}
    for _ in range(3):                 # JVM/JIT warm-up before anything is timed
        sinks.run_noop(registry.gold_daily(spark, sf, "broadcast"))

    # 1. Silver from the written bronze table, and everything after it from a silver table that is written:
    # the gold tables with a broadcast and with a sort-merge join to the dimension.
    q["silver_trips"] = timed(lambda: registry.silver(spark, sf))
    silver_path = scratch_path(spark, "silver")
    sinks.rebuild(registry.silver(spark, sf), silver_path)
    s = lambda: spark.read.parquet(silver_path)
    q["gold_daily_broadcast"] = timed(lambda: gold.daily_zone_revenue(s(), registry.zones(spark, sf), "broadcast"))
    q["gold_daily_merge"] = timed(lambda: gold.daily_zone_revenue(s(), registry.zones(spark, sf), "merge"))
    q["gold_hourly"] = timed(lambda: gold.hourly_demand(s(), registry.zones(spark, sf)))
    q["gold_rebuild_from_silver"] = q["gold_daily_broadcast"]

    # 2. Most generous borough: native expression, Arrow UDF, redundant repartition.
    z = lambda: registry.zones(spark, sf)
    q["generous_native"] = timed(lambda: gold.generous_borough(s(), z(), "broadcast", "native"))
    q["generous_pandas_udf"] = timed(lambda: gold.generous_borough(s(), z(), "broadcast", "vectorized"))
    q["generous_repartition500"] = timed(lambda: gold.generous_borough(s(), z(), "broadcast", "native", 500))
    # The slow job of the baseline (UDF, redundant repartition(500), sort-merge join) against the
    # fast one (native expression, checked broadcast), both on written trips.
    raw_path = scratch_path(spark, "raw_for_tips")
    sinks.rebuild(registry.raw_for_tips(spark, sf), raw_path)
    r = lambda: spark.read.parquet(raw_path)
    q["fast_job_raw"] = timed(lambda: gold.generous_borough(r(), z(), "broadcast", "native"))
    q["slow_job_raw"] = timed(lambda: gold.generous_borough(r(), z(), "merge", "vectorized", 500))

    # 3. Skewed join: 90 % of lineitem on one supplier.
    def skew(mode):
        k = registry.skewed_lines(spark, sf)
        sup = domain.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
        if mode == "salted":
            hot = J.hot_key_rows(k, "l_suppkey", 0.01)
            j = J.salted_join(k, sup, "l_suppkey", "s_suppkey", max(16, J.salts_for(hot)), ["l_orderkey", "l_linenumber"],
                              hot=list(hot))
        else:
            j = J.join_dim(k, sup, F.col("l_suppkey") == F.col("s_suppkey"), "inner", "merge")
        return j.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("lines"))

    q["skew_join_plain"] = timed(lambda: skew("plain"))
    q["skew_join_salted"] = timed(lambda: skew("salted"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    q["skew_join_plain_no_aqe"] = timed(lambda: skew("plain"))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    q["skew_agg"] = timed(lambda: registry.q_skewed_agg(spark, sf))

    # 4. Upsert of 1 / 10 / 50 % of orders (changed payload) into all orders.
    orders = domain.table(spark, sf, "orders")
    n = orders.agg(F.max("o_orderkey")).first()[0] + 1
    for pct in (1, 10, 50):
        def up(pct=pct):
            src = (orders.filter(F.col("o_orderkey") < int(n * pct / 100))
                         .withColumn("o_totalprice", F.col("o_totalprice") + 1.0))
            return Vr.upsert(orders, src, ["o_orderkey"], check_unique=False)
        q[f"upsert_{pct}pct"] = timed(up)

    info = {"slow_over_fast": round(q["slow_job_raw"] / q["fast_job_raw"], 2)}

    # Merge one month of changed orders, with writes: full-table rewrite vs rewriting
    # only the touched year partition (partition pruning + dynamic overwrite).
    oy = orders.withColumn("o_year", F.year("o_orderdate"))
    month = ((F.col("o_orderdate") >= F.lit("1998-03-01").cast("timestamp_ntz"))
             & (F.col("o_orderdate") < F.lit("1998-04-01").cast("timestamp_ntz")))
    change = oy.filter(month).withColumn("o_totalprice", F.col("o_totalprice") + 1.0)

    def write_timed(fn, runs=RUNS):
        best = float("inf")
        for _ in range(runs + 1):
            t0 = time.perf_counter()
            fn()
            best = min(best, time.perf_counter() - t0)
        return round(best, 3)

    def full_rewrite():
        out = scratch_path(spark, "orders_full")
        sinks.rebuild(Vr.upsert(oy, change, ["o_orderkey"], check_unique=False), out, partition_by=["o_year"])

    def partition_merge():
        p = scratch_path(spark, "orders_by_year")
        sinks.write_partitioned(oy, p, ["o_year"])              # setup, timed separately below
        t0 = time.perf_counter()
        Vr.upsert_partitions(spark, p, change, ["o_orderkey"], "o_year", scratch_path(spark, "stage"))
        return time.perf_counter() - t0

    q["merge_month_full_rewrite"] = write_timed(full_rewrite)
    q["merge_month_touched_partitions"] = round(min(partition_merge() for _ in range(RUNS + 1)), 3)
    info["merge_month_rows_rewritten"] = {"full_rewrite": oy.count(),
                                          "touched_partitions": oy.filter(F.col("o_year") == 1998).count()}
    two = orders.filter(F.col("o_orderkey") < 2).withColumn("o_totalprice", F.col("o_totalprice") + 1.0)
    info["merge_2_rows"] = Vr.upsert_metrics(orders, two, ["o_orderkey"]).first().asDict()
    for lay, writer in (("sorted", lambda d, p: L.write_sorted(d, p, "o_orderkey", 16)),
                        ("random", lambda d, p: L.write_shuffled(d, p, 16))):
        p = scratch_path(spark, f"orders_{lay}")
        writer(orders, p)
        at = spark.read.parquet(p).select("o_orderkey", F.col("_metadata.file_path").alias("f"))
        info[f"merge_2_rows_files_{lay}"] = at.filter(F.col("o_orderkey") < 2).select("f").distinct().count()

    # One-day filter on a day-partitioned layout: partitions actually scanned.
    ev = domain.table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    by_day = scratch_path(spark, "events_by_day")
    sinks.write_partitioned(ev, by_day, ["day"])
    one = spark.read.parquet(by_day).filter(F.col("day") == F.lit("2024-01-15").cast("date"))
    scanned = one.select(F.col("_metadata.file_path")).distinct().count()
    info["one_day_partitions_scanned"] = f"{scanned}/{ev.select('day').distinct().count()}"
    q["one_day_partitioned"] = timed(lambda: spark.read.parquet(by_day)
                                     .filter(F.col("day") == F.lit("2024-01-15").cast("date"))
                                     .agg(F.count(F.lit(1)), F.avg("value")))
    q["one_day_unpartitioned"] = timed(lambda: domain.table(spark, sf, "events")
                                       .filter((F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
                                               & (F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")))
                                       .agg(F.count(F.lit(1)), F.avg("value")))

    # 5. Layout: a narrow part-key range over random / sorted / z-order / small files / compacted.
    li = domain.table(spark, sf, "lineitem")
    lo, hi = li.approxQuantile("l_partkey", [0.45, 0.5], 0.001)
    paths = {"random": scratch_path(spark, "random"), "sorted": scratch_path(spark, "sorted"),
             "zorder": scratch_path(spark, "zorder"), "small_files": scratch_path(spark, "small"),
             "compacted": scratch_path(spark, "compacted")}
    L.write_shuffled(li, paths["random"], 16)
    L.write_sorted(li, paths["sorted"], "l_partkey", 16)
    sinks.rebuild(L.zorder(li, ["l_partkey", "l_suppkey"], 16), paths["zorder"])
    L.write_small_batches(li, paths["small_files"], 1000)
    L.compact(spark, paths["small_files"], paths["compacted"], 16, "l_partkey")
    starts = [0.05 + 0.1 * i for i in range(9)]          # nine 5 % ranges at the deciles
    probs = sorted(set(starts + [x + 0.05 for x in starts]))
    at = dict(zip(probs, li.approxQuantile("l_partkey", probs, 0.001)))
    ranges = [(at[x], at[x + 0.05]) for x in starts]
    files_read = {}
    for name, p in paths.items():
        rows = spark.read.parquet(p).select("l_partkey", F.col("_metadata.file_path").alias("f"))
        inside = [F.countDistinct(F.when(F.col("l_partkey").between(lo9, hi9), F.col("f"))) for lo9, hi9 in ranges]
        got = rows.agg(*inside, F.countDistinct("f")).first()
        files_read[name] = f"{sum(got[:9]) / 9:.1f}/{got[9]} (files with rows, avg of 9 ranges)"
        q[f"layout_{name}"] = timed(lambda p=p: spark.read.parquet(p)
                                    .filter((F.col("l_partkey") >= lo) & (F.col("l_partkey") < hi))
                                    .agg(F.count(F.lit(1)), F.sum("l_quantity")))

    headline = ["gold_daily_broadcast", "gold_hourly", "silver_trips", "generous_native", "skew_join_salted",
                "skew_agg", "upsert_10pct", "layout_sorted"]
    total = round(sum(q[k] for k in headline), 3)
    m = re.search(r"sf([0-9.]+)", sf)
    print(json.dumps({"metric": "headline_total_min_of_3", "value": total, "unit": "sec", "queries": q,
                      "sf": float(m.group(1)) if m else sf, "cpus": CPUS, "files_read": files_read,
                      "info": info}))
    spark.stop()


if __name__ == "__main__":
    main()
