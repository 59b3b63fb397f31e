import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from keelson.operators import versions as V
from tests.helpers import rows

CHG_SCHEMA = "k int, p string, version long, seq long, op string"


def test_upsert_semantics(spark):
    # merge_pair: matched, unmatched, NULL key; duplicate source key must raise
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    src = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    assert rows(V.upsert(tgt, src, ["k"])) == [(1, "a"), (2, "B"), (3, "C"), (None, "N"), (None, "n")]
    m = V.upsert_metrics(tgt, src, ["k"]).first().asDict()
    assert m == {"source_rows": 3, "updated": 1, "inserted": 2, "copied": 2}
    dup = spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string")
    with pytest.raises(ValueError):
        V.upsert(tgt, dup, ["k"])


def test_upsert_idempotent_and_evolving(spark):
    tgt = spark.range(0, 100).withColumn("v", F.col("id") * 2)
    src = spark.range(90, 120).withColumn("v", F.col("id") * 3).withColumn("extra", F.lit("x"))
    once = V.upsert(tgt, src, ["id"])
    twice = V.upsert(once, src, ["id"])
    assert rows(once) == rows(twice)
    assert once.count() == 120
    assert once.filter("extra is null").count() == 90


def changes(spark):
    # insert, update, delete, re-insert, update of an unseen key, and a later change
    return spark.createDataFrame([
        (1, "a1", 0, 0, "insert"), (2, "b1", 0, 1, "insert"),
        (1, "a2", 1, 2, "update"), (2, None, 1, 3, "delete"),
        (3, "c1", 2, 4, "update"),
        (2, "b2", 3, 5, "insert"), (1, None, 3, 6, "delete"),
    ], CHG_SCHEMA)


def test_as_of_and_history(spark):
    c = changes(spark)
    state = lambda v: {r["k"]: r["p"] for r in V.as_of(c, ["k"], v).collect()}
    assert state(0) == {1: "a1", 2: "b1"}
    assert state(1) == {1: "a2"}
    assert state(2) == {1: "a2", 3: "c1"}
    assert state(None) == {2: "b2", 3: "c1"}
    h = {r["version"]: (r["n_insert"], r["n_update"], r["n_delete"]) for r in V.history(c).collect()}
    assert h == {0: (2, 0, 0), 1: (0, 1, 1), 2: (0, 1, 0), 3: (1, 0, 1)}
    assert [tuple(r) for r in V.rows_by_version(c, ["k"]).orderBy("version").collect()] == \
        [(0, 2), (1, 1), (2, 2), (3, 2)]


def test_restore_roundtrip(spark):
    c = changes(spark)
    for v in range(4):
        r = c.unionByName(V.restore(c, ["k"], v, ["p"]))
        assert rows(V.as_of(r, ["k"]).drop("version")) == rows(V.as_of(c, ["k"], v).drop("version"))
        assert r.agg(F.max("version")).first()[0] in (3, 4)  # history only grows


def test_snapshot_diff(spark):
    c = changes(spark)
    d = {r["k"]: r["change"] for r in V.snapshot_diff(V.as_of(c, ["k"], 0), V.as_of(c, ["k"], 2), ["k"], ["p"]).collect()}
    assert d == {1: "changed", 2: "removed", 3: "added"}


def test_check_schema(spark):
    base = spark.createDataFrame([(1, 2.0)], "id long, amt double")
    evo = spark.createDataFrame([(1, 2.0, 0.5)], "id long, amt double, tip double")
    with pytest.raises(ValueError):
        V.check_schema(evo, base.schema)
    merged = V.check_schema(evo, base.schema, evolve=True)
    assert merged.fieldNames() == ["id", "amt", "tip"]
    with pytest.raises(ValueError):
        V.check_schema(spark.createDataFrame([("x",)], "id string"), base.schema, evolve=True)
    u = V.union_evolving(base, evo)
    assert u.filter("tip is null").count() == 1


def test_rerun_growth(spark):
    b = spark.range(0, 10).withColumn("v", F.lit(1))
    got = {r["strategy"]: r["rows"] for r in V.rerun_growth(b, ["id"], 3).collect()}
    assert got == {"append": 30, "upsert": 10}


def test_growth_merges_shuffle_no_table(spark, sf_dir, monkeypatch):
    # The batch is loaded by merges that shuffle neither the table nor the batch, however large both are
    from keelson.operators.joins import needs_shuffle
    from keelson.plans import registry
    plain, merges = V.upsert, []

    def upsert(target, source, keys, **kw):
        merges.append(plain(target, source, keys, broadcast_max_rows=0, **kw))
        return merges[-1]
    monkeypatch.setattr(V, "upsert", upsert)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r["strategy"]: r["rows"] for r in registry.QUERIES["rerun_growth"](spark, sf_dir).collect()}
        shuffled = [needs_shuffle(m) for m in merges]
        rows_of_merge = [m.count() for m in merges]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    n = registry.silver(spark, sf_dir).count()
    assert got == {"append": 3 * n, "upsert": n} and rows_of_merge == [n, n]
    assert shuffled == [False, False]


def test_buckets_go_with_the_shuffles(spark):
    from keelson.sources import sinks as S
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n, want in (("8", 8), ("200", 200), ("120000", 10_000), ("10007", 1)):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert S.buckets_for(spark) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_upsert_of_bucketed_tables(spark):
    # M1, K8: new, changed and untouched keys, null keys on both sides and keys found twice in the source
    import re
    from keelson.operators.joins import needs_shuffle
    from keelson.session import scratch_path
    from keelson.sources import sinks as S
    setting = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(setting)
    key = F.when(F.col("id") % 10 != 9, F.unhex(F.md5(F.col("id").cast("string")))).alias("k")
    table = spark.range(0, 400, 1, 5).select(key, F.lit("old").alias("v"), (F.col("id") % 7).alias("at"))
    source = spark.range(300, 500, 1, 3).select(key, F.lit("new").alias("v"), (F.col("id") % 5).alias("at"))
    source = source.union(source.filter(F.col("at") == 0))
    bucketed = [S.materialize_bucketed(x.repartition(8, "k"), scratch_path(spark, "b"), ["k"], 8, ["at"]) for x in (table, source)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = V.upsert(*bucketed, ["k"], check_unique=False, broadcast_max_rows=0)
        assert not needs_shuffle(merged)
        out = S.materialize_bucketed(merged, scratch_path(spark, "b"), ["k"], 8, ["at"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    want = V.upsert(table, source, ["k"], check_unique=False)
    same = lambda df: sorted(map(str, df.collect()))
    assert same(out) == same(want) and out.count() == 310 + 240
    assert spark.conf.get(setting) == before
    # a file holds one bucket, and its rows are sorted
    files = out.select("at", F.col("_metadata.file_path").alias("f")).collect()
    assert {re.search(r"_(\d{5})\.", r["f"]).group(1) for r in files} <= {f"{i:05d}" for i in range(8)}
    assert all(x <= y for f in {r["f"] for r in files} for at in [[r["at"] for r in files if r["f"] == f]] for x, y in zip(at, at[1:]))


def test_pinned_reader_does_not_see_later_commits(spark):
    # M8: a reader pinned at version v sees the same rows after new commits land
    c = changes(spark)
    pinned = rows(V.as_of(c, ["k"], 1))
    later = c.unionByName(spark.createDataFrame([(9, "z", 4, 7, "insert"), (1, "a9", 4, 8, "update")], CHG_SCHEMA))
    assert rows(V.as_of(later, ["k"], 1)) == pinned
    assert rows(V.as_of(later, ["k"])) != rows(V.as_of(c, ["k"]))


def test_row_ids_unique(spark):
    from keelson.operators.ordered import row_ids
    df = row_ids(spark.range(0, 1000).repartition(7))
    assert df.select("row_id").distinct().count() == 1000


def test_upsert_metrics_paths_agree(spark):
    tgt = spark.createDataFrame([(i, "t") for i in range(20)] + [(None, "n")], "k int, v string")
    src = spark.createDataFrame([(i, "s") for i in range(15, 30)] + [(None, "m")], "k int, v string")
    small = V.upsert_metrics(tgt, src, ["k"]).first().asDict()
    big = V.upsert_metrics(tgt, src, ["k"], broadcast_max_rows=0).first().asDict()
    assert small == big == {"source_rows": 16, "updated": 5, "inserted": 11, "copied": 16}


def test_upsert_partitions_leaves_untouched_partitions_alone(spark, sf_dir):
    from keelson.plans import domain
    from keelson.session import scratch_path
    from keelson.sources import sinks

    o = domain.table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    path = scratch_path(spark, "by_year")
    sinks.write_partitioned(o, path, ["o_year"])
    files = lambda y: sorted(r[0] for r in spark.read.parquet(path).filter(F.col("o_year") == y)
                             .select(F.col("_metadata.file_path")).distinct().collect())
    before_1996 = files(1996)
    src = o.filter(F.year("o_orderdate") == 2000).withColumn("o_totalprice", F.lit(-1.0))
    touched = V.upsert_partitions(spark, path, src, ["o_orderkey"], "o_year", scratch_path(spark, "stage"))
    assert touched == [2000]
    assert files(1996) == before_1996                       # not rewritten
    after = spark.read.parquet(path)
    assert after.count() == o.count()
    assert after.filter("o_year = 2000 and o_totalprice <> -1.0").count() == 0


def test_overwrite_pair_keeps_history(spark):
    # FIXTURES overwrite pair: ids [1, 2, 3] then a whole overwrite with [4, 5, 6]
    first = spark.createDataFrame([(i, "a", 0, i, "insert") for i in (1, 2, 3)], CHG_SCHEMA)
    new = spark.createDataFrame([(i, "b") for i in (4, 5, 6)], "k int, p string")
    ow = V.overwrite(first, ["k"], new, ["p"])
    assert sorted((r["k"], r["op"]) for r in ow.collect()) == [(1, "delete"), (2, "delete"), (3, "delete"),
                                                               (4, "insert"), (5, "insert"), (6, "insert")]
    log = first.unionByName(ow)
    assert sorted(r["k"] for r in V.as_of(log, ["k"]).collect()) == [4, 5, 6]
    assert sorted(r["k"] for r in V.as_of(log, ["k"], 0).collect()) == [1, 2, 3]
    h = {r["version"]: (r["n_insert"], r["n_delete"]) for r in V.history(log).collect()}
    assert h == {0: (3, 0), 1: (3, 3)}


def test_a_merge_that_stops_half_way_is_finished(spark, monkeypatch):
    from keelson.session import scratch_path

    path, staging = scratch_path(spark, "half"), scratch_path(spark, "half_stage")
    base = spark.createDataFrame([(i, i % 3, "old") for i in range(30)], "k int, p int, v string")
    base.write.partitionBy("p").parquet(path)
    source = spark.createDataFrame([(k, 7, "new") for k in range(0, 30, 3)], "k int, p int, v string")   # empties p = 0
    want = rows(V.upsert(base, source, ["k"]))
    finish = V.finish_upsert

    def stops(spark, target, column, staged):                         # the partitions are replaced, the emptied one is not
        if not V.path_exists(spark, f"{staged}/touched/_SUCCESS"):
            return False
        merged = spark.read.schema(spark.read.parquet(f"{staged}/schema").schema).parquet(f"{staged}/merged")
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(target)
        raise KeyboardInterrupt

    read = lambda: spark.read.parquet(path).select("k", "p", "v")
    monkeypatch.setattr(V, "finish_upsert", stops)
    with pytest.raises(KeyboardInterrupt):
        V.upsert_partitions(spark, path, source, ["k"], "p", staging)
    assert rows(read()) != want                                       # moved keys are there twice
    monkeypatch.setattr(V, "finish_upsert", finish)
    assert V.finish_upsert(spark, path, "p", staging) and rows(read()) == want
    assert not V.finish_upsert(spark, path, "p", staging)             # nothing left to do
    again = spark.createDataFrame([(1, 1, "newer")], "k int, p int, v string")
    assert V.upsert_partitions(spark, path, again, ["k"], "p", staging) == [1]
    assert rows(read().filter("k = 1")) == [(1, 1, "newer")] and read().count() == 30
