"""Property tests over small random frames: upsert is idempotent and
matches a dict model, restore round-trips, salted join equals the plain join,
sequential ids equal row_number, dedup leaves unique keys."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from keelson.operators import joins as J
from keelson.operators import keyed as K
from keelson.operators import ordered as O
from keelson.operators import versions as V
from tests.helpers import rows

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.integers(0, 12))
kv = st.lists(st.tuples(keys, st.integers(-5, 5)), max_size=25)


@SETTINGS
@given(target=kv, source=st.lists(st.tuples(keys, st.integers(-5, 5)), max_size=15, unique_by=lambda t: t[0]))
def test_upsert_model_and_idempotence(spark, target, source):
    t = spark.createDataFrame(target, "k int, v int")
    s = spark.createDataFrame(source, "k int, v int")
    src_keys = {k for k, _ in source if k is not None}
    expect = [r for r in target if r[0] is None or r[0] not in src_keys] + source
    got = V.upsert(t, s, ["k"], check_unique=False)
    assert rows(got) == rows(spark.createDataFrame(expect, "k int, v int"))
    if all(k is not None for k, _ in source):
        assert rows(V.upsert(got, s, ["k"], check_unique=False)) == rows(got)


ops = st.sampled_from(["insert", "update", "delete"])
changes = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9), st.integers(0, 4), ops), min_size=1, max_size=30)


@SETTINGS
@given(chg=changes, v=st.integers(0, 4))
def test_as_of_model_and_restore(spark, chg, v):
    data = [(k, p, ver, i, op) for i, (k, p, ver, op) in enumerate(chg)]
    c = spark.createDataFrame(data, "k int, p int, version long, seq long, op string")
    state = {}
    for k, p, ver, i, op in sorted(data, key=lambda r: (r[2], r[3])):
        if ver > v:
            continue
        if op == "delete":
            state.pop(k, None)
        else:
            state[k] = p
    got = {r["k"]: r["p"] for r in V.as_of(c, ["k"], v).collect()}
    assert got == state
    restored = c.unionByName(V.restore(c, ["k"], v, ["p"]))
    assert {r["k"]: r["p"] for r in V.as_of(restored, ["k"]).collect()} == state


@SETTINGS
@given(pairs=st.lists(st.integers(0, 5), min_size=1, max_size=60), salts=st.integers(1, 6))
def test_salted_equals_plain(spark, pairs, salts):
    big = spark.createDataFrame(list(enumerate(pairs)), "id int, k int")
    small = spark.createDataFrame([(k, k * 10) for k in range(0, 5)], "sk int, w int")
    plain = big.join(small, big.k == small.sk)
    for hot in (None, J.hot_keys(big, "k", 0.3)):
        salted = J.salted_join(big, small, "k", "sk", salts, ["id"], hot=hot)
        assert rows(salted) == rows(plain)


@SETTINGS
@given(vals=st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=80, unique=True),
       parts=st.integers(1, 7), offset=st.integers(0, 1000))
def test_sequential_id_equals_row_number(spark, vals, parts, offset):
    df = spark.createDataFrame(vals, "g int, u int")
    got = O.sequential_id(df, ["g", "u"], "sid", offset=offset, partitions=parts)
    ref = df.withColumn("sid", F.row_number().over(Window.orderBy("g", "u")) + offset)
    assert rows(got) == rows(ref)


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 9)), max_size=40))
def test_dedup_unique_and_first(spark, data):
    df = spark.createDataFrame(data, "k int, o int, x int")
    d = K.dedup_first(df, ["k"], ["o"])
    got = {r["k"]: (r["o"], r["x"]) for r in d.collect()}
    assert len(got) == d.count()
    for k in {r[0] for r in data}:
        assert got[k] == min((o, x) for kk, o, x in data if kk == k)


@SETTINGS
@given(chg=changes)
def test_rows_by_version_model(spark, chg):
    data = [(k, p, ver, i, op) for i, (k, p, ver, op) in enumerate(chg)]
    c = spark.createDataFrame(data, "k int, p int, version long, seq long, op string")
    live, expect = {}, {}
    for k, p, ver, i, op in sorted(data, key=lambda r: (r[2], r[3])):
        live[k] = op != "delete"
        expect[ver] = sum(live.values())
    got = {r["version"]: r["live_rows"] for r in V.rows_by_version(c, ["k"]).collect()}
    assert got == expect




@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=st.lists(st.tuples(st.integers(0, 20), st.integers(-5, 5)), min_size=1, max_size=25, unique_by=lambda t: t[0]),
       source=st.lists(st.tuples(st.integers(0, 30), st.integers(-5, 5)), max_size=12, unique_by=lambda t: t[0]))
def test_upsert_partitions_equals_upsert(spark, target, source):
    from keelson.session import scratch_path
    t = spark.createDataFrame([(k, v, k % 3) for k, v in target], "k int, v int, p int")
    s = spark.createDataFrame([(k, v, k % 3) for k, v in source], "k int, v int, p int")
    path = scratch_path(spark, "prop_parts")
    t.write.partitionBy("p").parquet(path)
    V.upsert_partitions(spark, path, s, ["k"], "p", scratch_path(spark, "prop_stage"))
    got = spark.read.parquet(path).select("k", "v", "p")
    assert rows(got) == rows(V.upsert(t, s, ["k"]).select("k", "v", "p"))


@SETTINGS
@given(a=st.dictionaries(st.integers(0, 15), st.integers(0, 3), max_size=12),
       b=st.dictionaries(st.integers(0, 15), st.integers(0, 3), max_size=12))
def test_snapshot_diff_model(spark, a, b):
    da = spark.createDataFrame(list(a.items()) or [(0, 0)], "k int, p int")
    db = spark.createDataFrame(list(b.items()) or [(0, 0)], "k int, p int")
    a = a or {0: 0}
    b = b or {0: 0}
    expect = {k: "removed" for k in a.keys() - b.keys()}
    expect.update({k: "added" for k in b.keys() - a.keys()})
    expect.update({k: "changed" for k in a.keys() & b.keys() if a[k] != b[k]})
    got = {r["k"]: r["change"] for r in V.snapshot_diff(da, db, ["k"]).collect()}
    assert got == expect


@SETTINGS
@given(keys=st.lists(st.integers(0, 200), min_size=1, max_size=300), share=st.sampled_from([0.05, 0.1, 0.25]))
def test_hot_keys_bound(spark, keys, share):
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    hot = J.hot_keys(df, "k", share)
    assert len(hot) <= int(1 / share)
    counts = {k: keys.count(k) for k in set(keys)}
    assert set(hot) == {k for k, n in counts.items() if n >= max(1, math.ceil(len(keys) * share))}
