import pytest
from pyspark.sql import functions as F

from keelson.operators.quality import GateFailed
from keelson.plans import domain, registry, runner
from keelson.plans import medallion as M
from keelson.session import scratch_path


def test_layer_run_gates_and_is_idempotent(spark, sf_dir):
    raw = domain.raw_trips(spark, sf_dir)
    seed = domain.zone_seed(spark, sf_dir)
    root = scratch_path(spark, "lake")
    months = ["1996-05", "1997-05"]
    r1 = runner.run_layers(spark, raw, seed, root, "1", months=months, source_file="lineitem.parquet",
                                ingested_at=M.RUN_TS)
    assert all(n == 0 for _, n in r1.checks) and len(r1.checks) == 15
    s1 = spark.read.parquet(r1.silver)
    # second run: incremental on run 1, same input -> same silver rows, bronze unchanged
    r2 = runner.run_layers(spark, raw, seed, root, "2", previous_silver=r1.silver, months=months,
                               source_file="lineitem.parquet", ingested_at=M.RUN_TS)
    s2 = spark.read.parquet(r2.silver)
    assert s2.count() == s1.count() > 0
    assert spark.read.parquet(r2.bronze).count() == raw.filter(
        F.date_format("tpep_pickup_datetime", "yyyy-MM").isin(months)).count()
    g = spark.read.parquet(r2.gold_daily)
    assert g.agg(F.sum("trip_count")).first()[0] == s2.count()


def test_gate_stops_gold(spark, sf_dir):
    raw = domain.raw_trips(spark, sf_dir)
    seed = domain.zone_seed(spark, sf_dir)
    root = scratch_path(spark, "lake")
    loose = M.SilverVars(max_trip_hours=99999)
    with pytest.raises(GateFailed):
        runner.run_layers(spark, raw, seed, root, "1", v=loose, duration_hours=12,
                              source_file="lineitem.parquet")
    with pytest.raises(Exception):
        spark.read.parquet(f"{root}/gold_daily/run=1").count()


def test_incremental_partitions_mode_repairs_backfill(spark, sf_dir):
    b = registry.bronze(spark, sf_dir)
    full = M.silver_trips(b)
    late = F.col("_pickup_month") == "1996-03"
    target = M.silver_trips(b.filter(~late))              # month 1996-03 arrives late
    wm = runner.run_incremental(b, target, mode="watermark")
    assert wm.count() < full.count()                      # the watermark misses the back-fill
    part = runner.run_incremental(b, target, mode="partitions", months=["1996-03"])
    assert part.count() == full.count() and part.exceptAll(full).count() == 0


def test_append_day_is_not_idempotent(spark, sf_dir):
    b = registry.bronze(spark, sf_dir)
    p = scratch_path(spark, "sandbox")
    day = "1997-06-02"
    for _ in range(3):
        runner.append_day(b, day, p)
    once = registry.QUERIES["sandbox_day"](spark, sf_dir).count()
    assert spark.read.parquet(p).count() == 3 * once


def test_cli_ingest_months_and_rerun(spark, sf_dir, capsys):
    import json

    from keelson.__main__ import main
    raw = domain.raw_trips(spark, sf_dir)
    src = scratch_path(spark, "raw_files")
    raw.write.parquet(src)
    bronze = scratch_path(spark, "bronze_cli")
    for _ in range(2):                                   # re-run: same rows, no duplicates
        assert main(["ingest", "--raw", src, "--bronze", bronze, "1996-05", "1997-05"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    expect = raw.filter(F.date_format("tpep_pickup_datetime", "yyyy-MM").isin("1996-05", "1997-05")).count()
    assert out == {"months": ["1996-05", "1997-05"], "bronze_rows": expect}
    files = spark.read.parquet(bronze).select("_source_file").distinct().collect()
    assert all(r[0].endswith(".parquet") for r in files)


def test_stale_rows_stay_with_watermark_but_not_with_partitions(spark, sf_dir):
    b = registry.bronze(spark, sf_dir)
    loose = M.SilverVars()
    strict = M.SilverVars(max_trip_hours=1)                 # tighten the duration cap
    target = M.silver_trips(b, loose)
    months = [r[0] for r in target.select("pickup_month").distinct().collect()]
    too_long = F.expr("timestampdiff(SECOND, pickup_at, dropoff_at)") > strict.max_trip_hours * 3600
    stale = target.filter(too_long).count()
    assert stale > 0
    wm = runner.run_incremental(b, target, strict, mode="watermark")
    assert wm.filter(too_long).count() > 0                    # merge has no delete branch
    part = runner.run_incremental(b, target, strict, mode="partitions", months=months)
    assert part.filter(too_long).count() == 0
    assert part.count() == M.silver_trips(b, strict).count()


def test_cli_run_on_raw_files_and_zone_csv(spark, sf_dir, capsys, tmp_path):
    import json

    from keelson.__main__ import main
    raw = domain.raw_trips(spark, sf_dir)
    src = scratch_path(spark, "raw_files")
    raw.write.parquet(src)
    zones = domain.zone_seed(spark, sf_dir).toPandas()
    csv = tmp_path / "zones.csv"
    zones.to_csv(csv, index=False)
    root = scratch_path(spark, "lake_cli")
    assert main(["run", "--raw", src, "--zones-csv", str(csv), "--root", root, "--run-id", "1",
                 "--months", "1996-05", "--var", "max_trip_hours=12", "--var", "start_date=1996-01-01"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert all(n == 0 for _, n in out["checks"])
    assert spark.read.parquet(out["gold_daily"]).count() > 0


def test_cli_check_and_sandbox(spark, sf_dir, capsys):
    import json

    from keelson.__main__ import main
    raw = domain.raw_trips(spark, sf_dir)
    seed = domain.zone_seed(spark, sf_dir)
    root = scratch_path(spark, "lake_chk")
    r = runner.run_layers(spark, raw, seed, root, "7", months=["1996-05"], source_file="lineitem.parquet")
    assert main(["check", "--root", root, "--run-id", "7"]) == 0
    assert main(["check", "--root", root, "--run-id", "7", "--duration-hours", "1"]) == 1   # mutation fails
    sandbox = scratch_path(spark, "sandbox_cli")
    for _ in range(2):
        assert main(["sandbox", "--bronze", r.bronze, "--day", "1996-05-02", "--path", sandbox]) == 0
    out = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines() if x.startswith("{")]
    once = registry.bronze(spark, sf_dir).filter(
        F.to_date("tpep_pickup_datetime") == F.lit("1996-05-02").cast("date")).count()
    assert out[-1] == {"sandbox_rows": 2 * once}


def test_watermark_prunes_partitions(spark, sf_dir):
    raw = domain.raw_trips(spark, sf_dir)
    root = scratch_path(spark, "lake_wm")
    months = ["1996-05", "1997-05", "1998-05"]
    r1 = runner.run_layers(spark, raw, domain.zone_seed(spark, sf_dir), root, "1", months=months,
                           source_file="lineitem.parquet", ingested_at=M.RUN_TS)
    silver = spark.read.parquet(r1.silver)
    bronze = spark.read.parquet(r1.bronze)
    newest = silver.filter(F.col("pickup_month") == "1998-05")
    assert "PartitionFilters" in newest._jdf.queryExecution().executedPlan().toString()
    f = M.since_watermark(bronze, silver)
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_pickup_month" in plan.split("PartitionFilters")[1][:200]
    expect = bronze.filter(F.col("tpep_pickup_datetime") >= silver.agg(F.max("pickup_at")).first()[0])
    assert f.count() == expect.count()
    assert f.select(F.col("_metadata.file_path")).distinct().count() == \
        bronze.filter("_pickup_month = '1998-05'").select(F.col("_metadata.file_path")).distinct().count()


def test_merge_mode_rewrites_only_new_months(spark, sf_dir):
    raw = domain.raw_trips(spark, sf_dir)
    seed = domain.zone_seed(spark, sf_dir)
    root = scratch_path(spark, "lake_merge")
    kw = dict(source_file="lineitem.parquet", ingested_at=M.RUN_TS, silver_mode="merge")
    r1 = runner.run_layers(spark, raw, seed, root, "1", months=["1996-05", "1997-05"], **kw)
    files = lambda m: sorted(r[0] for r in spark.read.parquet(r1.silver).filter(F.col("pickup_month") == m)
                             .select(F.col("_metadata.file_path")).distinct().collect())
    old = files("1996-05")
    r2 = runner.run_layers(spark, raw, seed, root, "2", months=["1997-05", "1998-05"], **kw)
    assert r2.silver == r1.silver and all(n == 0 for _, n in r2.checks)
    assert files("1996-05") == old                         # untouched month not rewritten
    full = M.silver_trips(M.to_bronze(raw, "lineitem.parquet", M.RUN_TS).filter(
        F.col("_pickup_month").isin("1996-05", "1997-05", "1998-05")))
    got = spark.read.parquet(r2.silver)
    assert got.count() == full.count()
    assert got.select("trip_id").exceptAll(full.select("trip_id")).count() == 0
    # gold daily: month-partitioned, only touched months recomputed, equal to a rebuild
    from keelson.plans import gold as G
    rebuilt = G.daily_zone_revenue(got, spark.read.parquet(r2.zones))
    gd = spark.read.parquet(r2.gold_daily).drop("pickup_month")
    assert gd.count() == rebuilt.count() and gd.exceptAll(rebuilt).count() == 0
    hourly = spark.read.parquet(r2.gold_hourly)
    full_hourly = G.hourly_demand(got, spark.read.parquet(r2.zones))
    assert hourly.count() == full_hourly.count() and hourly.exceptAll(full_hourly).count() == 0


TAXI_SEED = [(4, "Manhattan", "Alphabet City", "Yellow Zone"), (2, "Queens", "Jamaica Bay", "Boro Zone"), (11, "Brooklyn", "Bath Beach", "Boro Zone"),
             (3, "Bronx", "Allerton", "Boro Zone"), (5, "Staten Island", "Arden Heights", "Boro Zone"), (1, "EWR", "Newark Airport", "EWR"),
             (264, "Unknown", "N/A", "N/A"), (265, "N/A", "Outside of NYC", "N/A")]


@pytest.mark.parametrize("mode", ["snapshot", "merge"])
def test_run_on_own_files_with_taxi_boroughs(spark, sf_dir, tmp_path, capsys, mode):
    import json

    from keelson.__main__ import main

    zones = [z for z, *_ in TAXI_SEED]
    pick = lambda c: F.element_at(F.array(*[F.lit(z) for z in zones]), (F.pmod(F.xxhash64(c), F.lit(8)) + 1).cast("int"))
    raw = domain.raw_trips(spark, sf_dir).withColumn("PULocationID", pick("PULocationID")).withColumn("DOLocationID", pick("DOLocationID"))
    raw.write.parquet(f"{tmp_path}/raw")
    with open(f"{tmp_path}/zones.csv", "w") as f:
        f.write("LocationID,Borough,Zone,service_zone\n" + "".join(",".join(map(str, r)) + "\n" for r in TAXI_SEED))
    args = ["run", "--raw", f"{tmp_path}/raw", "--zones-csv", f"{tmp_path}/zones.csv", "--root", f"{tmp_path}/lake", "--run-id", "1",
            "--silver-mode", mode, "--publish", f"own_{mode}"]
    assert main(args) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert len(out["checks"]) == 15 and all(n == 0 for _, n in out["checks"])
    daily = spark.read.parquet(out["gold_daily"])
    assert {r[0] for r in daily.select("borough").distinct().collect()} == {b for _, b, *_ in TAXI_SEED}
    assert spark.table(f"own_{mode}_gold_daily_zone_revenue").count() == daily.count()
    assert spark.table(f"own_{mode}_silver_trips").count() == spark.read.parquet(out["silver"]).count() > 0
    with pytest.raises(GateFailed):                                  # without the taxi boroughs the same files fail
        main([*args[:8], "2", "--silver-mode", mode, "--var", "boroughs=Manhattan,Queens"])


def test_row_checks_are_counted_while_writing(spark, tmp_path):
    from keelson.operators import quality as Q

    df = spark.range(0, 1000).select(F.when(F.col("id") % 100 == 0, F.lit(None)).otherwise(F.col("id")).alias("x"), "id").repartition(7)
    rules = [("x_not_null", F.col("x").isNull()), ("id_small", F.col("id") >= 990), ("id_there", F.col("id").isNull())]
    seen, counted = Q.observed(df, rules)
    seen.write.parquet(f"{tmp_path}/t")
    assert counted() == [("x_not_null", 10), ("id_small", 10), ("id_there", 0)]
    assert [(r["check"], r["failures"]) for r in Q.count_failures(spark.read.parquet(f"{tmp_path}/t"), rules).collect()] == counted()
    with pytest.raises(GateFailed):
        Q.gate([], counted())
    empty, none = Q.observed(df.limit(0), rules)
    empty.write.parquet(f"{tmp_path}/e")
    assert Q.gate([], none()) == [(n, 0) for n, _ in rules]


def test_a_table_that_cannot_be_read_is_not_taken_for_missing(spark, tmp_path):
    from keelson.streaming import jobs

    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_text("no parquet")
    fn = jobs.upsert_batches_partitioned(f"{tmp_path}/t", ["k"], ["k"], "p", f"{tmp_path}/stage")
    with pytest.raises(Exception):
        fn(spark.createDataFrame([(1, "a")], "k int, p string"), 0)
    assert (tmp_path / "t" / "part-0.parquet").read_text() == "no parquet"
