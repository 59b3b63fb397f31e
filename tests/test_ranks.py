"""Order statistics by histogram refinement against plain sorting."""

import datetime as dt
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keelson.operators import ordered, ranks


def key(v):
    """Spark's ascending order: null, numbers, NaN."""
    return (v is not None, isinstance(v, float) and math.isnan(v), 0 if v is None or (isinstance(v, float) and math.isnan(v)) else v)


def expected(rows, n, offset):
    return sorted(rows, key=lambda r: tuple(key(v) for v in r))[offset:offset + n]


def got(df, order, n, offset, enough):
    return [tuple(r) for r in ordered.batch_slice(df, order, n, offset, enough).collect()]


def same(a, b):
    return [tuple(map(repr, r)) for r in a] == [tuple(map(repr, r)) for r in b]


SPECIAL = [None, math.nan, math.inf, -math.inf, 0.0, 1e308, -1e308, 5e-324]


@pytest.mark.parametrize("kind, make", [
    ("long", lambda r: r.choice([None, r.randint(-(1 << 63), (1 << 63) - 1), r.randint(0, 9), (1 << 60) + r.randint(0, 500)])),
    ("double", lambda r: r.choice([*SPECIAL, r.random(), r.gauss(0, 1e9)])),
    ("string", lambda r: r.choice([None, "", "a\0", "a", "zz", "same prefix " + str(r.randint(0, 999)), "é" + str(r.random()), "漢字"])),
    ("date", lambda r: r.choice([None, dt.date(1970, 1, 1) + dt.timedelta(r.randint(-9000, 9000))])),
    ("timestamp_ntz", lambda r: dt.datetime(2000, 1, 1) + dt.timedelta(microseconds=r.randint(-10 ** 15, 10 ** 15))),
    ("boolean", lambda r: r.choice([None, True, False])),
])
def test_slices_of_every_type(spark, kind, make):
    rng = random.Random(kind)
    rows = [(make(rng), i) for i in range(3_000)]
    df = spark.createDataFrame(rows, f"k {kind}, i long").repartition(4).cache()
    for offset, n in ((0, 5), (1_234, 50), (2_990, 50), (5_000, 3), (7, 0)):
        assert same(got(df, ["k", "i"], n, offset, 20), expected(rows, n, offset))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.text(max_size=3)), st.integers()
                          .filter(lambda v: -(1 << 63) <= v < 1 << 63)), min_size=1, max_size=60, unique=True),
       st.integers(0, 40), st.integers(1, 20))
def test_slices_of_composite_orders(spark, rows, offset, n):
    df = spark.createDataFrame(rows, "a int, b string, c long")
    plain = [tuple(r) for r in df.orderBy(*[F.col(c).asc_nulls_first() for c in "abc"]).collect()]
    assert got(df, ["a", "b", "c"], n, offset, 2) == plain[offset:offset + n]


def test_a_large_batch_is_numbered_not_gathered(spark):
    df = spark.range(0, 30_000).select((F.col("id") * 7919 % 30_011).alias("k"))
    out = ordered.batch_slice(df, ["k"], 9_000, 12_345, enough=500)
    plain = sorted(i * 7919 % 30_011 for i in range(30_000))[12_345:21_345]
    assert sorted(r["k"] for r in out.collect()) == plain


def test_few_rows_are_left_deep_in_a_table(spark):
    df = spark.range(0, 2_000_000).select((F.col("id") * 48_271 % 2_147_483_647).alias("k"))
    first, last = ranks.locate(df, ["k"], [1_500_001, 1_500_100])
    assert 0 < first.rows <= ranks.ENOUGH and 0 < last.rows <= ranks.ENOUGH
    out = ordered.batch_slice(df, ["k"], 100, 1_500_000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "TakeOrderedAndProject" in plan      # no sort of the table
    assert [r["k"] for r in out.collect()] == sorted(i * 48_271 % 2_147_483_647 for i in range(2_000_000))[1_500_000:1_500_100]


def test_filters_reach_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    out = ordered.batch_slice(orders, ["o_orderkey"], 10, 500, enough=50)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = out._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(o_orderkey" in plan and "LessThanOrEqual(o_orderkey" in plan


def test_ties_in_every_column_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "x")] * 500 + [(None, None)] * 300, "a int, b string")
    assert got(df, ["a", "b"], 3, 299, 10) == [(None, None), (1, "x"), (1, "x")]
    assert got(df.limit(0), ["a", "b"], 3, 0, 10) == []


def test_search_is_a_count_of_splits(spark):
    splits = [0.5 * i for i in range(777)]
    df = spark.createDataFrame([(float(v),) for v in (-1, 0, 0.25, 0.5, 200.1, 388, 1e9)], "x double")
    assert [r[0] for r in df.select(ranks.search(F.col("x"), splits)).collect()] == [0, 1, 1, 2, 401, 777, 777]
    assert df.select(ranks.search(F.col("x"), [])).distinct().collect()[0][0] == 0


def test_weighted_cells(spark):
    rng = random.Random(4)
    rows = [(rng.choice([7, 7, 7, rng.randint(0, 10 ** 12), None]), float(rng.randint(1, 9))) for _ in range(4_000)]
    df = spark.createDataFrame(rows, "x long, w double")
    found = ranks.cells(df, "x", "w", 1 / 50)
    total = sum(w for _, w in rows)
    assert sum(c.weight for c in found) == total
    assert all(a.high < b.low for a, b in zip(found, found[1:]))
    assert all(c.low == c.high or c.weight <= total / 50 for c in found)
    for c in found:
        assert c.weight == sum(w for x, w in rows if (-math.inf if x is None else x) >= c.low and (-math.inf if x is None else x) <= c.high)
    assert ranks.cells(df.limit(0), "x", "w", 0.1) == []


def test_position_is_compiled_search(spark):
    xs = [None, float("nan"), float("inf"), -float("inf"), -3.0, 0.0, 0.5, 1.0, 7.0, 1e300]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for splits in ([], [0.5], [-3.0, 0.0, 1.0, 7.0], [0.0, 0.0, 1.0], [-float("inf"), 0.0, float("inf")]):
        got = ranks.with_position(df, "p", F.col("x"), splits).select("p", ranks.search(F.col("x"), splits).alias("q")).collect()
        assert [r["p"] for r in got] == [r["q"] for r in got], splits


def test_layout_passes_hold_no_interpreted_steps(spark):
    from keelson.operators import layout as L
    df = spark.range(2000).select("id", (F.col("id") * 7 % 100).alias("v"))
    plan = lambda x: x._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan(L.with_zorder_key(df, ["id", "v"], "z"))
    p = L.SizePlan((0.0, 10.0, 20.0), (0, 1, 3), (1, 2, 1))
    filed = p.with_file(df.withColumn("n", F.col("v").cast("double")), "f", "n", F.xxhash64("id"))
    assert "lambda" not in plan(filed)
    for r in filed.collect():
        assert r["f"] in ({0} if r["v"] < 10 else {1, 2} if r["v"] < 20 else {3})
