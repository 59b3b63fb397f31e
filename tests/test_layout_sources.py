from pyspark.sql import functions as F

from keelson.operators import layout as L
from keelson.plans import medallion as M
from keelson.plans import domain, runner
from keelson.session import scratch_path
from keelson.sources import readers as R
from keelson.sources import sinks as S
from tests.helpers import rows

import pytest


def test_zorder_and_compaction_keep_rows(spark, sf_dir):
    li = domain.table(spark, sf_dir, "lineitem")
    z = scratch_path(spark, "z")
    S.rebuild(L.zorder(li, ["l_partkey", "l_suppkey"], 8), z)
    assert rows(spark.read.parquet(z)) == rows(li)
    small = scratch_path(spark, "small")
    L.write_small_batches(li, small, 20)
    comp = L.compact(spark, small, scratch_path(spark, "c"), 2, "l_shipdate")
    assert rows(comp.select(*li.columns)) == rows(li)
    assert L.layout_summary(spark, small).first()["files"] == 20


def test_partition_pruning_and_replace(spark, sf_dir):
    raw = domain.raw_trips(spark, sf_dir)
    p = scratch_path(spark, "bronze")
    for m in ["1997-01", "1997-02", "1997-01"]:
        runner.ingest(raw, p, [m], "x", M.RUN_TS)
    b = R.read_months(spark, p, ["1997-01"])
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_pickup_month" in plan
    expect = raw.filter(F.date_format("tpep_pickup_datetime", "yyyy-MM") == "1997-01").count()
    assert b.count() == expect
    with pytest.raises(ValueError):
        S.replace_partition(M.to_bronze(raw, "x", M.RUN_TS), p, "_pickup_month", "1997-01")


def test_seed_csv_keeps_quotes_and_na(spark, tmp_path):
    f = tmp_path / "zones.csv"
    f.write_text('LocationID,Borough,Zone,service_zone\n103,Manhattan,"Governor\'s Island/Ellis Island",Yellow Zone\n'
                 '265,N/A,Outside of NYC,N/A\n')
    z = M.silver_zones(R.load_seed(spark, str(f), "LocationID int, Borough string, Zone string, service_zone string"))
    got = {r["zone_id"]: (r["borough"], r["zone_name"]) for r in z.collect()}
    assert got == {103: ("Manhattan", "Governor's Island/Ellis Island"), 265: ("N/A", "Outside of NYC")}


def test_inferred_csv_and_footprint(spark, sf_dir):
    o = domain.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    p = scratch_path(spark, "csv")
    S.write_as(o, p, "csv")
    back = R.read_csv_inferred(spark, p)
    assert dict(back.dtypes) == {"o_orderkey": "int", "o_totalprice": "double"}
    fp = {r["format"]: r["bytes"] for r in L.format_footprint(spark, o, scratch_path(spark, "fp")).collect()}
    assert fp["parquet_zstd"] < fp["csv"] < fp["json"]


def test_footprint_has_one_format_on_disk_at_a_time(spark, monkeypatch):
    # Every format is written whole; each makes room for the next once its bytes are counted
    from keelson.session import path_exists
    t = spark.range(0, 3000, 1, 3).select("id", (F.col("id") % 7).alias("n"), F.lit("text").alias("s"))
    paths = {keep: scratch_path(spark, "fp") for keep in (True, False)}
    names, plain, seen = [f[0] for f in L.FOOTPRINT_FORMATS], S.write_as, []
    there = lambda root: [n for n in names if path_exists(spark, f"{root}/{n}")]

    def write_as(df, path, fmt="parquet", codec=None, mode="overwrite"):
        root, name = path.rsplit("/", 1)
        before = there(root)
        plain(df, path, fmt, codec, mode)
        back = spark.read.option("header", True).csv(path) if fmt == "csv" else spark.read.format(fmt).load(path)
        seen.append((root, name, before, back.distinct().count()))
    monkeypatch.setattr(S, "write_as", write_as)
    got = {keep: [tuple(r) for r in L.format_footprint(spark, t, p, keep=keep).collect()] for keep, p in paths.items()}
    assert got[True] == got[False] and len(got[False]) == 5
    assert [x[1:] for x in seen if x[0] == paths[False]] == [(n, [], 3000) for n in names]
    assert there(paths[True]) == names and there(paths[False]) == []
    size = {n: sum(r[0] for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{paths[True]}/{n}")
                   .select("length").collect()) for n in names}
    assert {r[0]: r[1] for r in got[False]} == size
    assert {r[0]: r[2] for r in got[False]} == pytest.approx({n: size["csv"] / b for n, b in size.items()}, abs=0.0051)


def test_footprint_queries_leave_no_files(spark, sf_dir, monkeypatch):
    from keelson.plans import registry
    from keelson.session import path_exists
    made = []

    def path(spark, name):
        made.append(scratch_path(spark, name))
        return made[-1]
    monkeypatch.setattr(registry, "scratch_path", path)
    assert registry.QUERIES["footprint_order"](spark, sf_dir).collect() == [("parquet_zstd", 5)]
    assert registry.QUERIES["format_footprint"](spark, sf_dir).count() == 5
    assert len(made) == 2
    assert not [p for p in made for f in L.FOOTPRINT_FORMATS if path_exists(spark, f"{p}/{f[0]}")]


def test_two_column_partitions_and_named_table(spark, sf_dir):
    ev = domain.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")).withColumn("hour", F.hour("ts"))
    p = scratch_path(spark, "day_hour")
    S.write_partitioned(ev, p, ["day", "hour"])
    back = R.read_partitioned(spark, p)
    assert back.count() == ev.count()
    assert back.select("day", "hour").distinct().count() == ev.select("day", "hour").distinct().count()
    S.save_named(ev.select("event_id", "user_id"), "keelson_test_events", path=scratch_path(spark, "named"))
    try:
        assert R.read_named(spark, "keelson_test_events").count() == ev.count()
    finally:
        spark.sql("DROP TABLE IF EXISTS keelson_test_events")


def test_partition_count_and_profile(spark):
    from keelson.operators import skew as X
    df = spark.range(0, 1000, numPartitions=5)
    assert X.partition_count(df).first()["partitions"] == 5
    assert sorted(r["rows"] for r in X.partition_profile(df).collect()) == [200] * 5


def test_bucketed_tables_join_without_shuffle(spark, sf_dir):
    li = domain.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    od = domain.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    S.write_bucketed(li, "kt_lines", scratch_path(spark, "b_lines"), ["l_orderkey"], 8)
    S.write_bucketed(od, "kt_orders", scratch_path(spark, "b_orders"), ["o_orderkey"], 8)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        j = spark.table("kt_lines").join(spark.table("kt_orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == li.join(od, F.col("l_orderkey") == F.col("o_orderkey")).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.sql("DROP TABLE IF EXISTS kt_lines")
        spark.sql("DROP TABLE IF EXISTS kt_orders")


def test_read_paths_names_only_wanted_files(spark, sf_dir):
    ev = domain.table(spark, sf_dir, "events")
    root = scratch_path(spark, "by_day_files")
    days = ["2024-01-03", "2024-01-04", "2024-01-05"]
    for d in days:
        ev.filter(F.to_date("ts") == F.lit(d).cast("date")).write.parquet(f"{root}/{d}")
    two = R.read_paths(spark, [f"{root}/{d}" for d in days[:2]])
    assert two.count() == ev.filter(F.to_date("ts").isin(days[:2])).count()
    assert two.select(F.col("_metadata.file_path")).distinct().filter(
        F.col("file_path").contains(days[2])).count() == 0


@pytest.mark.parametrize("target", [30_000, 60_000, 10 ** 9])
def test_files_have_the_target_size(spark, sf_dir, target):
    li = domain.table(spark, sf_dir, "lineitem")
    small, out = scratch_path(spark, "small"), scratch_path(spark, "sized")
    L.write_small_batches(li, small, 40)
    comp = L.compact(spark, small, out, order="l_shipdate", target_bytes=target)
    report = L.size_report(spark, out, target).first()
    assert report["fits"] and report["rows"] == li.count() and (report["files"] == 1) == (target == 10 ** 9)
    assert rows(comp.select(*li.columns)) == rows(li)
    spans = comp.groupBy(F.col("_metadata.file_path")).agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b")).collect()
    spans.sort(key=lambda r: r["a"])
    assert all(x["b"] < y["a"] for x, y in zip(spans, spans[1:]))      # files are disjoint ranges


def test_sizes_follow_bytes_not_rows(spark):
    # The last tenth of the keys carries nearly all bytes, one key a third of the rows, some none.
    text = F.concat_ws("", *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 256) for i in range(12)])
    df = spark.range(0, 12_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(777)).when(F.col("id") % 97 == 0, F.lit(None)).otherwise(F.col("id")).cast("long").alias("k"),
        F.when(F.col("id") >= 10_800, text).otherwise(F.substring(text, 1, 24)).alias("t"), F.col("id").alias("i"))
    src, out = scratch_path(spark, "uneven"), scratch_path(spark, "uneven_sized")
    df.repartition(8).write.parquet(src)
    comp = L.compact(spark, src, out, order="k", target_bytes=60_000)
    report = L.size_report(spark, out, 60_000).first()
    assert report["fits"], report
    assert rows(comp.select(*df.columns)) == rows(df)


def test_plan_of_files():
    from keelson.operators.ranks import Cell
    assert L.plan_files([], 10).total == 1
    one = L.plan_files([Cell(1, 1, 5), Cell(2, 3, 30), Cell(4, 4, 100), Cell(5, 9, 5)], 20)
    assert one.total >= 6 and max(one.files) == 5                       # the heavy value has files of its own
    even = L.plan_files([Cell(i, i + 0.5, 1) for i in range(1000)], 100)
    assert even.total == 10 and all(n == 1 for n in even.files)


def test_unordered_compaction_and_empty_tables(spark, sf_dir):
    li = domain.table(spark, sf_dir, "lineitem")
    small = scratch_path(spark, "small")
    L.write_small_batches(li, small, 30)
    assert rows(L.compact(spark, small, scratch_path(spark, "any"), target_bytes=40_000).select(*li.columns)) == rows(li)
    none = scratch_path(spark, "none")
    li.limit(0).write.parquet(none)
    assert L.compact(spark, none, scratch_path(spark, "none_out"), order="l_partkey").count() == 0


def test_malformed_records_go_to_quarantine(spark, tmp_path):
    schema = "id long, zone string, fare double"
    (tmp_path / "c").mkdir()
    (tmp_path / "j").mkdir()
    (tmp_path / "c" / "a.csv").write_text('id,zone,fare\n1,"Governor\'s, Island",2.5\n2,N/A,3\nx,A,1\n3,B\n4,C,N/A\n5,"D,1\n6,E,7,8\n7,,\n')
    (tmp_path / "c" / "b.csv").write_text("id,zone,fare\n8,F,1e3\n")
    (tmp_path / "j" / "a.json").write_text('{"id": 1, "zone": "A", "fare": 2.5}\n{"id": "x"}\n{broken\n{"id": 2}\n')
    for fmt, folder, ids, n_bad in (("csv", "c", [1, 2, 7, 8], 5), ("json", "j", [1, 2], 2)):
        good, bad = R.read_quarantined(spark, f"{tmp_path}/{folder}", schema, scratch_path(spark, "parsed"), fmt)
        assert good.schema.simpleString() == "struct<id:bigint,zone:string,fare:double>"
        assert sorted(r["id"] for r in good.collect()) == ids and bad.count() == n_bad
        assert {r["file"] for r in bad.collect()} == {f"a.{fmt}"}
    good, bad = R.read_quarantined(spark, f"{tmp_path}/c", schema, scratch_path(spark, "parsed"))
    got = {r["id"]: (r["zone"], r["fare"]) for r in good.collect()}
    assert got[1] == ("Governor's, Island", 2.5) and got[2][0] == "N/A" and got[7] == (None, None)
    assert {r["record"] for r in bad.collect()} == {"x,A,1", "3,B", "4,C,N/A", '5,"D,1', "6,E,7,8"}
    with pytest.raises(ValueError):
        R.read_quarantined(spark, str(tmp_path), schema, scratch_path(spark, "parsed"), "orc")


def test_sketches_of_parts_merge(spark):
    from keelson.operators import skew as X

    df = spark.range(0, 60_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                       (F.col("id") * 7919 % 60_000).cast("double").alias("v"), F.pmod("id", F.lit(5)).alias("part"))
    one = X.merged(X.sketches(df, "k", "v", ["part"]))
    assert one.first()["rows"] == 60_000
    (hot,) = X.heavy_keys(one, 1).collect()
    assert hot["key"] == 7 and abs(hot["n"] - 20_001) <= 60
    for r in X.sketched_quantiles(one, [0.01, 0.5, 0.99]).collect():
        assert abs(r["value"] / 60_000 - r["p"]) <= 0.02
    assert "Exchange hashpartitioning(k" not in X.sketches(df, "k", "v")._jdf.queryExecution().executedPlan().toString()


def test_files_of_a_layout_grow_with_the_table(spark):
    df = spark.range(25)
    assert [L.files_for(df, 2, 10), L.files_for(df, 8, 10), L.files_for(df.limit(0), 8, 10)] == [3, 8, 8]


def test_one_day_layouts_sort_bounded_files(spark, sf_dir, monkeypatch):
    from keelson.plans import registry
    paths = []
    monkeypatch.setattr(registry, "scratch_path", lambda s, n: paths.append(scratch_path(s, n)) or paths[-1])
    monkeypatch.setattr(L.files_for, "__defaults__", (500,))
    assert registry.QUERIES["one_day_layouts"](spark, sf_dir).count() == 3
    for kind in ("trips_sorted", "trips_shuffled"):
        path = next(p for p in paths if kind in p)
        held = [r[0] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().select("count").collect()]
        assert len(held) > 8 and max(held) < 1500 and sum(held) == domain.raw_trips(spark, sf_dir).count()


def test_text_copies_of_the_trips_are_compressed(spark, sf_dir, monkeypatch):
    from keelson.plans import registry
    paths = []
    monkeypatch.setattr(registry, "scratch_path", lambda s, n: paths.append(scratch_path(s, n)) or paths[-1])
    got = registry.QUERIES["format_trio"](spark, sf_dir).collect()
    assert {r["format"] for r in got} == {"csv", "json", "parquet"}
    names = [r[0] for p in paths if "_csv" in p or "_json" in p
             for r in spark.read.format("binaryFile").load(p).select("path").collect()]
    assert names and all(n.endswith(".gz") for n in names)
