"""Validity intervals, digests and Bloom filters against the operators they stand for."""

import random

import pytest
from pyspark.sql import functions as F

from keelson.operators import bloom as B
from keelson.operators import digests as D
from keelson.operators import intervals as I
from keelson.operators import joins as J
from keelson.operators import versions as V
from keelson.session import scratch_path
from tests.helpers import rows

SCHEMA = "k int, p string, version long, seq long, op string"


def history(spark, seed=1, keys=30, versions=12):
    rng, out = random.Random(seed), []
    for v in range(versions):
        for i in range(rng.randint(0, 25)):
            out.append((rng.choice([None, *range(keys)]), f"p{rng.randint(0, 9)}", v, i, rng.choice(["insert", "update", "update", "delete"])))
    return spark.createDataFrame(out, SCHEMA)


@pytest.mark.parametrize("cut", [None, 0, 5, 11])
def test_intervals_give_every_state(spark, cut):
    c = history(spark)
    life = I.fold(c, ["k"]) if cut is None else I.fold_in(I.fold(c.filter(F.col("version") <= cut), ["k"]), c.filter(F.col("version") > cut), ["k"])
    path = scratch_path(spark, "life")
    I.write(life, path)
    stored = I.read(spark, path)
    assert rows(stored.drop("is_open")) == rows(I.fold(c, ["k"]).select(*stored.drop("is_open").columns))
    for v in (0, 4, 5, 11, None):
        assert rows(I.state_at(stored, v)) == rows(V.as_of(c, ["k"], v).select(*I.state_at(stored, v).columns))
    live = I.live_rows(stored.drop("is_open"), c.select("version").distinct())
    assert rows(live) == rows(V.rows_by_version(c, ["k"]))
    held = I.held_between(stored, 3, 4).select("k", "valid_from").distinct().count()
    both = V.as_of(c, ["k"], 3).select("k", "version").union(V.as_of(c, ["k"], 4).select("k", "version")).distinct().count()
    assert held == both


def test_interval_reads_have_no_aggregate(spark):
    path = scratch_path(spark, "life")
    I.write(I.fold(history(spark), ["k"]), path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    then, now = (I.state_at(I.read(spark, path), v)._jdf.queryExecution().executedPlan().toString() for v in (5, None))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for plan in (then, now):
        assert "Aggregate" not in plan and "Exchange" not in plan and "Window" not in plan
    assert "LessThanOrEqual(valid_from,5)" in then and "GreaterThan(valid_to,5)" in then
    assert "PartitionFilters" in now and "is_open" in now.split("PartitionFilters")[1].split("]")[0]


def test_intervals_of_nothing(spark):
    none = history(spark).limit(0)
    assert I.fold(none, ["k"]).count() == 0
    assert I.state_at(I.fold_in(I.fold(none, ["k"]), history(spark), ["k"]), 3).count() == V.as_of(history(spark), ["k"], 3).count()


def table(spark, n=20_000):
    return spark.range(0, n).select((F.col("id") * 3).alias("k"), (F.col("id") % 7).cast("string").alias("a"), (F.col("id") * 0.5).alias("b"))


def changed(df):
    """One key in a hundred changed, in one stretch; some removed, some added, one null payload."""
    near = (F.col("k") >= 30_000) & (F.col("k") < 30_600)
    return (df.filter(~(near & (F.col("k") % 9 == 0)))
            .withColumn("b", F.when(near & (F.col("k") % 2 == 0), F.lit(None)).otherwise(F.col("b")))
            .unionByName(df.limit(1).select(F.lit(30_001).cast("long").alias("k"), "a", "b")))


@pytest.mark.parametrize("keys", [["k"], ["k", "a"]])
def test_digests_give_the_same_difference(spark, keys):
    a, b = table(spark), changed(table(spark))
    paths = [scratch_path(spark, "snapshot") for _ in range(2)]
    for df, p in zip((a, b), paths):
        D.write_snapshot(df, keys, p, width=3_000, fine=50)
    assert rows(D.diff_snapshots(spark, *paths, keys)) == rows(V.snapshot_diff(a, b, keys))
    assert D.diff_snapshots(spark, paths[0], paths[0], keys).count() == 0


def test_only_differing_ranges_are_read(spark):
    a, b = table(spark), changed(table(spark))
    paths = [scratch_path(spark, "snapshot") for _ in range(2)]
    for df, p in zip((a, b), paths):
        D.write_snapshot(df, ["k"], p, width=3_000, fine=50)
    coarse = D.differing(*(spark.read.parquet(f"{p}/coarse") for p in paths), [D.COARSE])
    fine = D.differing(*(spark.read.parquet(f"{p}/fine") for p in paths), [D.COARSE, D.SMALL])
    assert coarse.count() == 1                                          # of twenty
    touched = D.read_rows(spark, paths[0]).join(fine, [D.COARSE, D.SMALL], "left_semi").count()
    assert 200 <= touched <= 240                                        # of 20,000 rows; 200 lie in the stretch
    out = D.diff_snapshots(spark, *paths, ["k"])
    read = {r[0].split("__coarse=")[1].split("/")[0] for r in D.read_rows(spark, paths[0]).filter(F.col(D.COARSE).isin(
        [r[0] for r in coarse.collect()])).select(F.col("_metadata.file_path")).distinct().collect()}
    assert read == {"10"} and "PartitionFilters: [isnotnull(__coarse" in out._jdf.queryExecution().executedPlan().toString()


def test_digests_of_odd_keys(spark):
    a = spark.createDataFrame([(None, "x"), (-5, "y"), (1 << 62, "z"), (-(1 << 62), "w")], "k long, v string")
    b = spark.createDataFrame([(None, "x"), (-5, None), (1 << 62, "z")], "k long, v string")
    paths = [scratch_path(spark, "odd") for _ in range(2)]
    for df, p in zip((a, b), paths):
        D.write_snapshot(df, ["k"], p)
    assert rows(D.diff_snapshots(spark, *paths, ["k"])) == [("changed", -5), ("removed", -(1 << 62))]


def test_bloom_filter_never_loses_a_partner(spark):
    source = spark.range(0, 30_000).select((F.col("id") * 17).alias("k"), F.col("id").cast("string").alias("t"))
    target = spark.range(0, 200_000).select(F.when(F.col("id") % 1000 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v"))
    for keys, s, t in ((["k"], source, target), (["k", "t"], source, target.withColumn("t", (F.col("k") / 17).cast("long").cast("string")))):
        maybe, clear = B.split(t, B.build(s, keys), keys)
        partners = t.join(s.select(*keys), keys, "left_semi").count()
        assert maybe.count() + clear.count() == t.count()
        assert clear.join(s, keys, "left_semi").count() == 0
        assert partners <= maybe.count() <= partners + 0.05 * t.count()


def test_reduced_upsert_shuffles_matches_only(spark, monkeypatch):
    monkeypatch.setattr(B, "fits_broadcast", lambda df: False)
    target = spark.range(0, 100_000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    source = spark.range(95_000, 101_000).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    nulls = spark.createDataFrame([(None, "n")], "k long, v string")
    target, source = target.unionByName(nulls), source.unionByName(nulls)
    out = B.upsert_reduced(target, source, ["k"])
    assert rows(out) == rows(V.upsert(target, source, ["k"]))
    maybe, _ = B.split(target, B.build(source, ["k"]), ["k"])
    assert maybe.count() < 10_000                                       # of 100,001 rows
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    assert rows(B.upsert_reduced(target, source, ["k"], max_words=1)) == rows(out)        # too large a filter: plain join
    with pytest.raises(ValueError):
        B.upsert_reduced(target, source.unionByName(source), ["k"])


def test_reduced_orphans_and_empty_sides(spark):
    child = spark.createDataFrame([(i % 50 if i % 9 else None, i) for i in range(500)], "c int, i int")
    parent = spark.createDataFrame([(i,) for i in list(range(0, 50, 3)) * 2], "p int")
    assert rows(B.orphans_reduced(child, parent, "c", "p")) == rows(J.orphans(child, parent, "c", "p"))
    assert rows(B.orphans_reduced(child, parent.limit(0), "c", "p")) == rows(child.filter("c is not null"))
    assert B.orphans_reduced(child.limit(0), parent, "c", "p").count() == 0
    assert rows(B.orphans_reduced(child, parent, "c", "p", max_words=0)) == rows(J.orphans(child, parent, "c", "p"))
