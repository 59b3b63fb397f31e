import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from keelson.functions.columns import surrogate_key
from keelson.operators import keyed as K
from keelson.operators import ordered as O
from tests.helpers import rows


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_dedup_first_exact_duplicate_and_ties(spark):
    # trips_dupes: exact duplicate, same key with different ingest time, same key+time tie
    df = spark.createDataFrame([
        ("a", ts("2024-01-02 00:00:00"), 1.0),
        ("a", ts("2024-01-01 00:00:00"), 2.0),
        ("b", ts("2024-01-01 00:00:00"), 5.0),
        ("b", ts("2024-01-01 00:00:00"), 5.0),
        ("c", ts("2024-01-01 00:00:00"), 9.0),
        ("c", ts("2024-01-01 00:00:00"), 3.0),
        (None, ts("2024-01-01 00:00:00"), 7.0),
    ], "k string, ingested timestamp, v double")
    out = {r["k"]: r["v"] for r in K.dedup_first(df, ["k"], ["ingested"]).collect()}
    assert out == {"a": 2.0, "b": 5.0, "c": 3.0, None: 7.0}


def test_dedup_handles_hot_key(spark):
    # one key holds most rows; the aggregate plan combines map side
    df = spark.range(0, 20000).select(F.when(F.col("id") % 3 != 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                      F.col("id").alias("v"))
    d = K.dedup_first(df, ["k"], ["v"])
    assert d.filter("k = 0").first()["v"] == 0
    assert d.count() == 1 + len(range(3, 20000, 3))
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_latest_by_key(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 3, "z"), (1, 2, "y"), (2, 1, "q")], "k int, ver int, p string")
    assert rows(K.latest_by_key(df, ["k"], ["ver"])) == [(1, "z", 3), (2, "q", 1)]


def test_duplicate_keys_and_assert_unique(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert [tuple(r) for r in K.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    with pytest.raises(ValueError):
        K.assert_unique(df, ["k"])
    K.assert_unique(df.filter("k = 2 or k is null"), ["k"])  # NULL keys never collide


def test_surrogate_key_null_collision(spark):
    # key_nulls: concat_ws skips NULLs, so moving a NULL makes two rows collide
    df = spark.createDataFrame([("1", None, "2"), (None, "1", "2")], "a string, b string, c string")
    keys = [r[0] for r in df.select(surrogate_key("a", "b", "c")).collect()]
    assert keys[0] == keys[1]


def test_sequential_id_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 7).alias("g"), (F.col("id") * 13 % 5000).alias("u"))
    got = O.sequential_id(df, ["g", "u"], "sid", offset=100, partitions=6)
    ref = df.withColumn("sid", F.row_number().over(Window.orderBy("g", "u")) + 100)
    assert rows(got) == rows(ref)
    assert got.agg(F.min("sid"), F.max("sid")).first() == (101, 5100)


def test_running_sum(spark):
    df = spark.createDataFrame([(v, v * 2) for v in range(1, 101)], "ver long, d long")
    got = {r["ver"]: r["running"] for r in O.running_sum(df, ["ver"], "d", partitions=5).collect()}
    assert got[1] == 2 and got[50] == sum(2 * i for i in range(1, 51)) and got[100] == 10100


def test_batch_slice_and_top_groups(spark):
    df = spark.range(0, 50).withColumn("k", F.col("id") % 4)
    assert [r["id"] for r in O.batch_slice(df, ["id"], 5, 10).collect()] == [10, 11, 12, 13, 14]
    top = [tuple(r) for r in O.top_groups(df, "k", 2).collect()]
    assert top == [(0, 13), (1, 13)]


def test_range_partitioning_splits_a_hot_key(spark):
    from keelson.operators.skew import partition_profile
    # a third of the rows share key 0; the tie-breaking column spreads them out
    df = spark.range(0, 30000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                      F.col("id").alias("u"))
    ranged = O.range_partitioned(df, ["k", "u"], partitions=8)
    sizes = [r["rows"] for r in partition_profile(ranged).collect()]
    assert len(sizes) == 8 and max(sizes) < 0.25 * 30000
    got = O.sequential_id(df, ["k", "u"], "sid", partitions=8)
    assert got.agg(F.min("sid"), F.max("sid"), F.countDistinct("sid")).first() == (1, 30000, 30000)


def test_running_sum_composite_order_uses_range_path(spark):
    df = spark.createDataFrame([(i // 10, i % 10, 1) for i in range(100)], "a long, b long, d long")
    got = {(r["a"], r["b"]): r["running"] for r in O.running_sum(df, ["a", "b"], "d", partitions=4).collect()}
    assert got[(0, 0)] == 1 and got[(9, 9)] == 100 and got[(5, 0)] == 51
