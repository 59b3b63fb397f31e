"""Every operator against a plain version, on nulls, empty and very long texts, ties, repeated
rows, empty tables and columns with clashing names."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from keelson.llm import (cleaning, components, decontaminate, license_scan, line_dedup, ngram_join, packing, preference,
                         quality_cnn, queries, sharding, substring_dedup)
from keelson.llm import textkit as tk
from tests.llm import brute

key = lambda rows: sorted(rows, key=repr)
rows_of = lambda df: key(tuple(r) for r in df.collect())


# ---- decontamination

ITEMS = [(1, "the quick brown fox jumps over the lazy dog and then it runs far away from here"), (2, "short item"), (3, None), (None, "null id"), (4, "...")]


@pytest.mark.parametrize("block_words", [150_000, 8])
def test_contamination_matches_brute_force(spark, edge, edge_rows, block_words):
    long = " ".join(brute.ALNUM.findall(brute.lower(edge_rows[2][1])))
    items = ITEMS + [(5, long), (5, long), (6, edge_rows[9][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(edge, bench, block_words=block_words)
    assert got.columns == [c for c in edge.columns if c != "contamination"] + ["contamination"]
    assert rows_of(got.select("doc_id", "contamination.n_words", "contamination.n_hit", "contamination.items")) == key(
        brute.contamination(edge_rows, items))


def test_contaminated_documents_go_and_spans_can_be_cut(spark, edge, edge_rows):
    bench = spark.createDataFrame([(5, edge_rows[2][1])], "item_id long, text string")
    kept = decontaminate.decontaminate(edge, bench)
    bad = {d for d, n, hit, _ in brute.contamination(edge_rows, [(5, edge_rows[2][1])]) if hit and 20 * hit >= n}
    assert bad and kept.columns == edge.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, _ in edge_rows if d not in bad)
    cut = decontaminate.decontaminate(edge, bench, percent=101, cut_spans=True).filter("doc_id = 2").first()
    assert brute.ALNUM.findall(cut.text) == []


def test_contamination_of_empty_tables(spark, edge, empty, edge_rows):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.decontaminate(edge, bench.limit(0)).count() == len(edge_rows)


# ---- similarity join

@pytest.mark.parametrize("n, num", [(3, 90), (5, 80), (1, 50)])
def test_groups_match_brute_force(edge, edge_rows, n, num):
    got = ngram_join.similar_groups(edge, n=n, num=num)
    want = brute.groups(edge_rows, n, num)
    # rows under one doc_id are told apart by their sets only
    assert rows_of(got) == key(want)


def test_signatures_meet_for_every_similar_pair():
    rng = np.random.default_rng(1)
    for num, growth in ((90, 1.25), (80, 1.5625), (50, 4.0)):
        enum = ngram_join.PartEnum(num, 100, growth)
        for _ in range(150):
            size = int(rng.integers(2, 400))
            a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2))
            drop, add = int(rng.integers(0, size // 3 + 1)), int(rng.integers(0, size // 3 + 1))
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 63, add).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if both * 100 >= num * (len(a) + len(b) - both) and not np.array_equal(a, b):
                assert set(enum.signatures(a).tolist()) & set(enum.signatures(b).tolist())


def test_copies_add_no_signatures_within_a_task(spark):
    one, other = (" ".join(f"{k}{i}" for i in range(50)) for k in "ab")
    scheme = ngram_join.PartEnum(90, 100, 1.25)
    docs = spark.createDataFrame([(one,)] * 700 + [(other,), (None,), (one.upper(),)], "text string").coalesce(1)
    got = Counter(tuple(r) for r in ngram_join.signature_rows(docs, "text", 3, scheme).collect())
    assert len({fp for fp, _, _ in got}) == 2 and set(got.values()) == {1}


def test_one_of_each_group_stays(edge, edge_rows, empty):
    kept = ngram_join.drop_similar(edge)
    want = {(d if c is not None else i) for i, (d, _, c) in enumerate(brute.groups(edge_rows, 5, 80)) if c is None or d == c}
    assert kept.columns == edge.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {d for d in ids if d is not None} == {d for d in want if isinstance(d, int) and d in {x for x, _ in edge_rows}}
    assert Counter(ids)[70] <= 1 and Counter(ids)[None] == 3
    assert ngram_join.drop_similar(empty).count() == 0


def test_rows_of_one_id_go_by_their_own_text(spark):
    texts = {k: " ".join(f"{k}{i}" for i in range(60)) for k in "abcdef"}
    rows = [(1, "a"), (2, "a"), (2, "b"), (3, "c"), (3, "d"), (3, "d"), (4, "e"), (4, "e2"), (None, "f"), (None, "f"), (None, None), (None, None),
            (5, None), (5, None), (5, "g")]
    texts |= {"e2": texts["e"] + " more", "g": "some other text", None: None}
    docs = spark.createDataFrame([(d, texts[k]) for d, k in rows], "doc_id long, text string")
    name = {v: k for k, v in texts.items()}
    got = [(r.doc_id, name[r.text]) for r in ngram_join.drop_similar(docs).collect()]
    assert [k for d, k in got if d == 4] in (["e"], ["e2"])
    assert key(x for x in got if x[0] != 4) == key([(1, "a"), (2, "b"), (3, "c"), (3, "d"), (None, "f"), (None, None), (None, None), (5, None), (5, "g")])


@pytest.mark.parametrize("task_links", [500_000, 15])
def test_components_of_chains_stars_and_loops(spark, task_links):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(9, 9), (160, 100), (-5, 3), (3, -5)]
    rng.shuffle(links)
    got = {r.node: r.label for r in components.components(
        spark.createDataFrame(links, "a long, b long").repartition(9), task_links=task_links).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 560)}, 9: 9, -5: -5, 3: -5}


# ---- licenses

def test_license_base_places(edge, edge_rows, empty):
    got = license_scan.license_report(edge).select("doc_id", "license.n_words", F.transform("license.base", lambda x: F.struct(x["start"], x["label"])).alias("b"))
    assert key((r.doc_id, r.n_words, [tuple(x) for x in r.b]) for r in got.collect()) == key((d, *brute.phrases(t)) for d, t in edge_rows)
    assert license_scan.license_report(empty).count() == 0


def test_license_rules_priority_and_containment():
    assert len(license_scan.signature_rules()) > 300
    detector = license_scan.Detector()
    scan = lambda t: next(detector.rows(next(tk.chunks(pa.array([t])))))[2]
    labels = lambda t: [x[2] for x in scan(t)]
    assert labels("Licensed under the Apache License, Version 2.0.") == ["apache-2.0"]
    assert labels("SPDX-License-Identifier: GPL-3.0 and the MIT license") == ["gpl-3.0", "mit"]
    assert labels("licensed under CC BY-NC 4.0") == ["cc-by-nc-4.0"]
    assert labels("GNU Lesser General Public License version 2.1") == ["lgpl-2.1"]
    assert labels("we limit emitters; no license here") == []
    keywords = {r.keyword for r in license_scan.signature_rules()}
    assert all(k in r.pattern.pattern.decode() for r in license_scan.signature_rules() for k in keywords if k == r.keyword)


# ---- classifier

def labelled(n=240):
    rng = random.Random(9)
    good = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta."]) for _ in range(rng.randint(30, 200)))
    bad = lambda: " ".join(rng.choice(["al###", "be$$$", "ga***"]) for _ in range(rng.randint(30, 200)))
    return [(i, good() if i % 2 else bad(), i % 2) for i in range(n)]


def test_classifier_learns_and_reads_whole_texts(spark, edge, edge_rows, empty):
    rows = labelled()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5000, 0), (3, None)], "doc_id long, quality int")
    model = quality_cnn.fit_quality(docs, labels, rows=80)
    scored = quality_cnn.quality_scores(docs, model).withColumn("held", quality_cnn.held_out()).collect()
    held = [r for r in scored if r.held]
    assert held and all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 2 == 1) for r in held]) > 0.95
    got = quality_cnn.quality_scores(edge, model)
    assert got.count() == len(edge_rows) and got.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert quality_cnn.quality_scores(empty, model).count() == 0
    # the end of a long text counts, and neighbours in a batch do not
    one = lambda *ts: model.scores(*(lambda c: (c.data, c.offsets))(next(tk.chunks(pa.array(list(ts))))))
    long = rows[1][1] * 50
    assert one(long)[0] != one(long + " " + rows[0][1])[0]
    assert one("", "a")[0] == one("")[0] == one("zzz ###", "")[1]


def test_classifier_never_sees_held_out_labels(spark):
    rows = labelled(120)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    flip = lambda i, y: 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y
    models = [quality_cnn.fit_quality(docs, spark.createDataFrame([(i, f(i, y)) for i, _, y in rows], "doc_id long, quality int"), rows=40)
              for f in (lambda i, y: y, flip)]
    assert np.array_equal(models[0].table, models[1].table) and np.array_equal(models[0].weights, models[1].weights)


def test_classifier_without_labels(spark, edge):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_cnn.quality_scores(edge, quality_cnn.fit_quality(edge, none)).collect()} == {0.5}


def test_classifier_gradients():
    model = quality_cnn.ByteCNN(3)
    model.bias += 0.05
    texts = [b"abc def ghi " * 60, b"## $$ %% " * 30]
    offsets = np.array([0, len(texts[0]), len(texts[0]) + len(texts[1])])
    data = np.frombuffer(b"".join(texts), np.uint8)
    y, w = np.array([1, 0], np.float32), np.array([0.5, 0.5])
    loss = lambda: float(-(w * np.log(np.where(y > 0, p := model.scores(data, offsets), 1 - p))).sum())
    grads = model._gradients(*model.padded(data, offsets), np.diff(offsets), y, w)
    for p, g in zip((model.table, model.bias, model.weights, model.offset), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep, eps = p[at], 1e-2
        p[at] = keep + eps
        up = loss()
        p[at] = keep - eps
        down = loss()
        p[at] = keep
        assert abs((up - down) / (2 * eps) - g[at]) < 0.05 * max(abs(g[at]), 0.02)


# ---- sharding

def test_ring_balances_exactly_and_moves_little(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    one, two = (sharding.shard_documents(docs, ring=sharding.Ring(shards=n)).toPandas().set_index("doc_id") for n in (24, 25))
    for got, n in ((one, 24), (two, 25)):
        sizes = got.groupby("shard").size()
        assert len(sizes) == n and sizes.max() - sizes.min() <= 1
        assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    assert (one.shard != two.shard.reindex(one.index)).mean() < 0.35       # a plain modulus moves 96 of 100
    ring = sharding.Ring()
    homes = {c: s for c, s in reversed(ring.points())}
    assert len({s for s in homes.values()}) == 24


def test_ring_on_edges(spark, edge, edge_rows, empty):
    got = sharding.shard_documents(edge).toPandas()
    assert len(got) == len(edge_rows) and got["shard"].value_counts().max() <= -(-len(edge_rows) // 24)
    want = key((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in edge_rows)
    assert key((None if d != d else int(d), int(s), int(c)) for d, s, c in zip(got.doc_id, got["size"], got.text_crc32, strict=True)) == want
    assert sharding.shard_documents(empty).count() == 0
    hot = spark.range(150_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    sizes = [r["count"] for r in sharding.shard_documents(hot).groupBy("shard").count().collect()]
    assert sum(sizes) == 150_000 and len(sizes) == 24 and max(sizes) - min(sizes) <= 1


# ---- packing

@pytest.mark.parametrize("one_per_source, group_pieces", [(False, 20_000), (True, 9)])
def test_packing_rules(edge, edge_rows, one_per_source, group_pieces):
    capacity = 100
    got = packing.pack(edge, capacity, one_per_source=one_per_source, group_pieces=group_pieces).toPandas()
    pieces = packing.pieces_of(edge, capacity).toPandas()
    assert len(got) == len(pieces)
    assert got.groupby("bin_id").n_words.sum().max() <= capacity
    assert got.n_words.sum() == sum(len(brute.SPACED.findall(t or "")) for _, t in edge_rows)
    assert all(sorted(g.position) == list(range(len(g))) for _, g in got.groupby("bin_id"))
    texts, sources = defaultdict(set), defaultdict(set)
    for r in edge.collect():
        texts[r.doc_id].add(r.text or "")
        sources[r.doc_id].add(r.source)
    single = {d: (next(iter(texts[d])), next(iter(sources[d]))) for d in texts if d is not None and len(texts[d]) == 1}
    for _, g in got.groupby("bin_id"):
        held = [single[d] for d in g.doc_id if d in single]
        assert len({t for t, _ in held}) == len(held)
        if one_per_source:
            named = [s for _, s in held if s is not None]
            assert len(set(named)) == len(named)


def test_best_fit_takes_the_tightest_compatible_bin():
    bins = packing.Bins(10)
    assert [bins.put(n, s, c) for n, s, c in [(6, 1, 0), (7, 2, 0), (3, 4, 0), (4, 1, 0), (4, 8, 0), (6, 16, 1), (1, 32, 1)]] == [0, 1, 1, 2, 0, 2, 3]


def test_blocks_choose_as_one_list_does():
    rng = random.Random(5)
    pieces = sorted(((rng.choice([0, 1, 7, 20, rng.randint(1, 60)]), 1 << rng.choice([0, 0, 0, *range(12)]), rng.choice([0, 0, 1, 2])) for _ in range(900)),
                    reverse=True)
    order, held, want = [], [], []
    for n, s, c in pieces:
        b = next((b for room, b in sorted(order) if room >= n and not (held[b][0] & s or held[b][1] & c)), len(held))
        if b == len(held):
            order.append((60, b))
            held.append((0, 0))
        room = next(r for r, x in order if x == b)
        order.remove((room, b))
        order += [(room - n, b)] if room > n else []
        held[b] = (held[b][0] | s, held[b][1] | c)
        want.append(b)
    bins = packing.Bins(60, block=4)
    assert [bins.put(*x) for x in pieces] == want


def test_registered_packing_keeps_sources_apart(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i}", "hot" if i % 3 else f"s{i % 4}") for i in range(90)] + [(100, "a", None), (101, "b", None)],
                                 "doc_id long, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    source = {r.doc_id: r.source for r in docs.collect()}
    for got in (queries.QUERIES["op6_best_fit"](spark, str(tmp_path)), corpus_pipeline.sequences(spark, docs, str(tmp_path))):
        got = got.toPandas()
        assert sorted(got.doc_id) == sorted(source)
        got["source"] = got.doc_id.map(source)
        assert got[got.source.notna()].groupby(["bin_id", "source"]).size().max() == 1
        assert got.bin_id.nunique() == 60


def test_packing_is_tight_and_empty(spark, empty):
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, " ".join(["w"] * rng.randint(1, 300)) + f" {i}", None) for i in range(800)], "doc_id long, text string, source string")
    got = packing.pack(docs, 512).toPandas()
    assert got.n_words.sum() / (got.bin_id.nunique() * 512) > 0.97
    assert packing.pack(empty).count() == 0


# ---- substrings

def test_substrings_match_brute_force(edge, edge_rows, empty):
    got = substring_dedup.without_repeats(edge)
    assert got.columns == [*edge.columns, "substrings"]
    assert rows_of(got.select("doc_id", "substrings.n_words", "substrings.n_removed", "substrings.kept")) == key(brute.substrings(edge_rows))
    assert substring_dedup.without_repeats(empty).count() == 0


@pytest.mark.parametrize("window, crowd", [(20, 2), (5, 3), (20, 2000), (40, 2000)])
def test_substrings_of_similar_texts(spark, monkeypatch, window, crowd):
    monkeypatch.setattr(substring_dedup, "ANCHOR_SEGMENTS", crowd)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 300)
    rng = random.Random(window)
    words = [f"w{i}" for i in range(30)]
    base = [rng.choice(words) for _ in range(300)]
    rows = []
    for d in range(40):
        a, n = rng.randint(0, 200), rng.randint(10, 100)
        cut = base[a:a + n]
        for _ in range(rng.randint(0, 3)):
            cut[rng.randrange(len(cut))] = rng.choice(words)
        rows.append((d, " ".join([rng.choice(words) for _ in range(rng.randint(0, 8))] + cut)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.without_repeats(docs, window=window).select("doc_id", "substrings.n_words", "substrings.n_removed", "substrings.kept")
    assert rows_of(got) == key(brute.substrings(rows, window))


# ---- quality rules

def test_quality_counts(edge, edge_rows, empty):
    got = cleaning.quality_report(edge).select("doc_id", "quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_dup_lines",
                                               "quality.n_repeat_words", "quality.base_failed")
    want = []
    for d, t in edge_rows:
        ws, ls = brute.SPACED.findall(t or ""), [x for x in (t or "").split("\n") if brute.SPACED.search(x)]
        n, rep = len(ws), brute.repeat_words(ws)
        want.append((d, n, sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t or ""), len(ls) - len(set(ls)), rep, n < 20 or 100 * rep > 30 * n))
    assert rows_of(got) == key(want)
    assert cleaning.quality_report(empty).count() == 0


def test_failing_lines_go_and_clean_texts_stay(spark):
    good = "This line is an ordinary sentence with quite enough words in it to be kept, as it should be."
    other = "Another sentence follows here, which says something else in words of its own, so nothing repeats."
    rows = [(1, f"{good}\nhome | about | news | contact | login\n{other} And more."), (2, "home | about | news\n" * 9), (3, f"{good} Twice as long as that."),
            (4, f"{good}\nPlease accept all cookies.\n\n{other} So there."), (5, "WOW!! " * 30), (6, None), (7, f"{good} {other[:-1]} #1?")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("quality", F.lit("kept as it is"))
    got = {r.doc_id: r for r in cleaning.clean(docs).collect()}
    assert sorted(got) == [1, 3, 4, 7] and {r.quality for r in got.values()} == {"kept as it is"}
    assert got[1].text == f"{good}\n{other} And more." and got[4].text == f"{good}\n\n{other} So there." and got[7].text == rows[6][1]


# ---- preference pairs

def test_conversations_and_pairs(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 1, "assistant", "hello"), (1, 2, "user", "bye"),
             (2, 0, "system", None), (2, 1, "assistant", "no"), (3, 0, "user", "alone"), (None, 0, "user", "x"), (4, None, "user", "x"),
             (5, 0, None, "odd"), (5, 1, "assistant", "same"), (6, 0, "user", "q"), (6, 1, "assistant", "same")]
    convs = preference.conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    assert {r.conv_id: len(r.turns) for r in convs.collect()} == {1: 3, 2: 2, 3: 1, 5: 2, 6: 2}
    got = {r.pair_id: r for r in preference.preference_rows(preference.mismatched_pairs(convs)).collect()}
    assert {k: r.rejected_id for k, r in got.items()} == {1: 2, 2: 5, 5: 6, 6: 1}   # whatever the gaps, and around the end
    one, same = got[1], got[5]
    assert one.n_prompt_turns == 1 and one.prompt == "<|user|>\nhi<|end|>\n"
    assert one.chosen_text == "<|assistant|>\nhello<|end|>\n" and one.rejected_text == "<|assistant|>\nno<|end|>\n"
    (span,) = one.chosen_mask
    assert one.chosen_text[span.start:span.end] == "hello<|end|>\n"
    assert same.n_prompt_turns == 2 and same.chosen_text == same.rejected_text == "" and same.chosen_mask == []
    assert got[2].n_prompt_turns == 0 and got[2].rejected_text.startswith("<||>\nodd")    # parts at the first turn
    alone = preference.mismatched_pairs(convs.filter("conv_id = 6")).collect()
    assert [(r.pair_id, r.rejected_id, r.chosen == r.rejected) for r in alone] == [(6, 6, True)]
    assert preference.mismatched_pairs(convs.filter("conv_id = 3")).count() == 0


def test_every_answered_conversation_is_paired(spark, sf_dir):
    convs = preference.conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet").filter("conv_id % 7 != 3"))
    answered = convs.filter(F.exists("turns", lambda t: t["role"] == "assistant"))
    rows = preference.preference_rows(preference.mismatched_pairs(convs)).collect()
    assert len(rows) == answered.count() and {r.pair_id for r in rows} == {r.conv_id for r in answered.collect()}
    assert len({r.rejected_id for r in rows}) == len(rows)
    assert len({r.n_prompt_turns for r in rows}) > 1


def test_preference_prefixes(spark):
    t = lambda *xs: [("user" if i % 2 == 0 else "assistant", x) for i, x in enumerate(xs)]
    rows = [(1, t("a", "b", "c", "d"), t("a", "b", "x", "d")), (2, t("a"), t("a", "b")), (3, t("a"), t("b")), (4, None, t("a")), (5, [], []),
            (6, t("é" * 9, "ü"), t("é" * 9, "漢字"))]
    kind = "array<struct<role:string,text:string>>"
    pairs = spark.createDataFrame(rows, f"k long, chosen {kind}, rejected {kind}")
    got = {r.k: r for r in preference.preference_rows(pairs).collect()}
    assert {k: r.n_prompt_turns for k, r in got.items()} == {1: 2, 2: 1, 3: 0, 4: 0, 5: 0, 6: 1}
    assert got[2].chosen_text == "" and got[2].rejected_text == "<|assistant|>\nb<|end|>\n" and got[4].rejected_text.startswith("<|user|>")
    for r in got.values():
        for text, mask in ((r.chosen_text, r.chosen_mask), (r.rejected_text, r.rejected_mask)):
            assert "".join(text[s.start:s.end] for s in mask) == "".join(
                x.split("|>\n", 1)[1] + "<|end|>\n" for x in text.split("<|end|>\n") if x.startswith("<|assistant"))
    assert preference.preference_rows(pairs.limit(0)).count() == 0


def test_preference_rows_replace_clashing_columns(spark):
    kind = "array<struct<role:string,text:string>>"
    pairs = spark.createDataFrame([([("user", "a")], [("user", "b")], "x", "y", "z", 1)],
                                  f"chosen {kind}, rejected {kind}, prompt string, shared string, __p string, n_prompt_turns int")
    (row,) = preference.preference_rows(pairs).collect()
    assert row.prompt == "" and row.shared == "y" and row["__p"] == "z" and row.n_prompt_turns == 0


# ---- lines

def test_rows_without_ids_are_told_apart(spark):
    # Many rows without an id: what is gathered for one of them is its own.
    shared = [f"a line that many of the rows hold, number {i}" for i in range(60)]
    rows = [(None, "\n".join([f"own line of the row number {i}", *shared[i % 50:i % 50 + 5]])) for i in range(1500)]
    rows += [(None, rows[0][1])] * 300 + [(7, shared[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    drops = line_dedup.repeated_lines(docs)
    assert drops.agg(F.max(F.size("dropped"))).first()[0] <= 5 and drops.count() <= 1500
    got = line_dedup.drop_repeated_lines(docs).select("doc_id", "lines.n_lines", "lines.n_dropped", "lines.kept")
    assert rows_of(got) == key(brute.lines(rows))
    words = lambda i: " ".join(f"w{i}x{j}" for j in range(30))
    passages = [(None, words(i % 400) + " " + words(1000 + i)) for i in range(800)]
    spans = substring_dedup.without_repeats(spark.createDataFrame(passages, "doc_id long, text string"))
    assert rows_of(spans.select("doc_id", "substrings.n_words", "substrings.n_removed", "substrings.kept")) == key(brute.substrings(passages))


def test_long_texts_of_many_lines(spark):
    lines = [f"this is line number {i} of a long text" for i in range(100_000)]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(reversed(lines))), (3, "\n".join(lines + lines))], "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_dropped, len(r.kept)) for r in line_dedup.drop_repeated_lines(docs).select("doc_id", "lines.*").collect()}
    assert got == {1: (100_000, 100_000, 0), 2: (100_000, 100_000, 0), 3: (200_000, 0, 2 * len("\n".join(lines)) + 1)}


@pytest.mark.parametrize("seed", range(40))
def test_uncontained_detections(seed):
    rng = random.Random(seed)
    seen = sorted((rng.randint(0, 2), -n, a, a + n, rng.choice("xy"), 0.5) for n, a in ((rng.randint(1, 6), rng.randint(0, 25)) for _ in range(30)))
    taken = []
    for _, _, start, end, label, weight in seen:
        if not any(a <= start and end <= b for a, b, _, _ in taken):
            taken.append((start, end, label, weight))
    assert license_scan.uncontained(seen) == taken


def test_long_texts_of_license_lines():
    line = "All rights reserved. Licensed under the Apache License, Version 2.0. cc by General Public License, without warranty.\n"
    ((n, base, taken),) = license_scan.Detector().rows(next(tk.chunks(pa.array([line * 3_000]))))
    assert len(base) == 9_000 and n == 18 * 3_000 and {(b - a) > 0 for a, b, _, _ in taken} == {True}
    assert len(taken) % 3_000 == 0                       # every line is like the first


@pytest.mark.parametrize("batches, fanout", [(4, 4), (7, 2), (1, 2)])
def test_lines_match_brute_force(spark, edge, edge_rows, batches, fanout):
    got = line_dedup.drop_repeated_lines(edge, batches=batches, fanout=fanout)
    assert got.columns == [c for c in edge.columns if c != "lines"] + ["lines"]
    assert rows_of(got.select("doc_id", "lines.n_lines", "lines.n_dropped", "lines.kept")) == key(brute.lines(edge_rows))
    cleaned = line_dedup.dedup_lines(edge)
    assert cleaned.columns == edge.columns and cleaned.filter("text IS NULL").count() == sum(t is None for _, t in edge_rows)


def test_line_runs_compact_and_find_what_is_new(spark, empty):
    batch = lambda i: spark.createDataFrame([(i, f"this is line number {i // 2} of the text\nand a line that all of them share")], "doc_id long, text string")
    runs, new = line_dedup.LineRuns(spark, fanout=2), []
    for i in range(7):
        keys = line_dedup.line_keys(batch(i))
        new.append(runs.novel(keys).count())
        runs.add(keys)
    assert new == [2, 0, 1, 0, 1, 0, 1]
    assert [len(level) for level in runs.levels] == [1, 1, 1]
    assert sorted(r.n_docs for r in runs.merged().collect()) == [1, 2, 2, 2, 7]
    assert line_dedup.drop_repeated_lines(empty).count() == 0


@pytest.mark.parametrize("small, chunk", [(8, 400), (0, 5), (2, 40)])
def test_groups_around_the_limit(spark, monkeypatch, small, chunk):
    """Near copies of one text whose similarity lies around the limit, so that hubs miss many."""
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", small)
    monkeypatch.setattr(ngram_join, "CHUNK_NODES", chunk)
    rng = random.Random(11)
    rows = []
    for g in range(4):
        base = [f"w{rng.randrange(500)}" for _ in range(140)]
        for d in range(30):
            ws = list(base)
            for _ in range(rng.choice([1, 2, 3, 4])):
                ws[rng.randrange(len(ws))] = f"new{rng.randrange(10_000)}"
            rows.append((1000 * g + d, " ".join(ws)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = ngram_join.similar_groups(docs)
    want = brute.groups(rows)
    assert len({c for _, _, c in want}) > 8 and rows_of(got) == key(want)


def test_contamination_holds_one_chunk_of_findings():
    import types

    import pyarrow as pa
    from pyspark import cloudpickle
    from pyspark.sql import types as T

    from keelson.llm import decontaminate as D
    from keelson.llm import textkit as tk

    words = " ".join(f"w{i}" for i in range(13))
    bench = types.SimpleNamespace(value=cloudpickle.dumps(D.Benchmark([("a", words)])))
    docs = types.SimpleNamespace(schema=T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())]),
                                 columns=["id", "text"], mapInArrow=lambda run, schema: run)
    texts = [f"{words} " + "x " * (tk.CHUNK_BYTES // 6), None, "", *["y " * (tk.CHUNK_BYTES // 6)] * 6, words]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["id", "text"])
    out = list(D._report(docs, bench, "text", "c")(iter([batch])))
    assert len(out) > 1 and sum(b.num_rows for b in out) == len(texts)
    got = [r for b in out for r in b.to_pylist()]
    assert [r["id"] for r in got] == list(range(len(texts))) and [r["text"] for r in got] == texts
    assert [r["c"]["n_hit"] for r in got] == [13, *[0] * (len(texts) - 2), 13]
