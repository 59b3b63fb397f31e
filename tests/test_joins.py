from pyspark.sql import functions as F

from keelson.operators import joins as J
from tests.helpers import rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_checked_broadcast_and_merge_hint(spark):
    big = spark.range(0, 10000).withColumn("k", F.col("id") % 25)
    dim = spark.range(0, 25).withColumnRenamed("id", "zk").withColumn("name", F.concat(F.lit("z"), F.col("zk")))
    b = J.join_dim(big, dim, F.col("k") == F.col("zk"), "left", "broadcast")
    assert "BroadcastHashJoin" in _plan(b)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        m = J.join_dim(big, dim, F.col("k") == F.col("zk"), "inner", "merge")
        assert "SortMergeJoin" in _plan(m)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert not J.fits_broadcast(big, 100)
    assert J.checked_broadcast(big, 100) is big


def test_salted_join_equals_plain(spark):
    big = J.with_hot_key(spark.range(0, 20000).withColumn("k", F.col("id") % 50), "k", 7, 90, by="id")
    small = spark.range(0, 50).select(F.col("id").alias("sk"), (F.col("id") * 10).alias("w"))
    plain = big.join(small, big.k == small.sk).groupBy("sk").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"))
    hot = J.hot_keys(big, "k", 0.05)
    assert hot == [7]
    for h in (None, hot):
        s = J.salted_join(big, small, "k", "sk", 8, salt_cols=["id"], hot=h)
        got = s.groupBy("sk").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"))
        assert rows(got) == rows(plain)
    left = J.salted_join(big, small.filter("sk != 3"), "k", "sk", 8, salt_cols=["id"], how="left")
    assert left.count() == big.count()


def test_hot_key_share(spark):
    df = J.with_hot_key(spark.range(0, 1000).withColumn("k", F.col("id") % 10), "k", 3, 90, by="id")
    assert df.filter("k = 3").count() == 900 + 10  # 90 % moved + the key's own rows in the rest


def test_orphans_ignore_null_keys(spark):
    # zones_missing: dimension without one referenced zone
    child = spark.createDataFrame([(1, "a"), (2, "b"), (99, "c"), (None, "d")], "z int, t string")
    parent = spark.createDataFrame([(1,), (2,)], "zid int")
    assert [r["t"] for r in J.orphans(child, parent, "z", "zid").collect()] == ["c"]


def test_probe_refuses_plans_that_shuffle(spark):
    big = spark.range(0, 5000).withColumn("k", F.col("id") % 10)
    agg = big.groupBy("k").count()                      # would need a shuffle to count
    assert J.needs_shuffle(agg) and not J.needs_shuffle(big)
    assert not J.fits_broadcast(agg)
    assert J.fits_broadcast(big)


def test_join_dim_salted_strategy(spark):
    big = J.with_hot_key(spark.range(0, 10000).withColumn("k", F.col("id") % 20), "k", 4, 60, by="id")
    dim = spark.range(0, 20).select(F.col("id").alias("dk"), (F.col("id") * 3).alias("w"))
    plain = big.join(dim, big.k == dim.dk)
    salted = J.join_dim(big, dim, None, "inner", "salted", keys=("k", "dk"), salts=8)
    assert rows(salted) == rows(plain)


def test_hot_key_of_equal_rows_is_split(spark, tmp_path):
    from keelson.plans import registry
    spark.range(400_000).select(
        (F.col("id") % 50).alias("l_suppkey"), F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"),
        F.lit(2.0).alias("l_quantity")).repartition(4).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(50).select(F.col("id").alias("s_suppkey"), (F.col("id") % 3).alias("s_nationkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    kept = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k"}
    for k, v in kept.items():
        spark.conf.set(k, v)
    try:
        df = registry._skewed_join(spark, str(tmp_path), "plain")
        got = {r["s_nationkey"]: r["lines"] for r in df.collect()}
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in kept:
            spark.conf.unset(k)
    assert got == {r["s_nationkey"]: r["lines"] for r in registry._skewed_join(spark, str(tmp_path), "salted").collect()}
    assert sum(got.values()) == 400_000
