"""Exact substring deduplication with suffix automata of reference shards.

A window is ``window`` consecutive words; each word covered by a window that starts earlier in
the corpus goes. The reference is the corpus itself, which no executor can hold, so shards are
dealt by content: each window belongs to the anchor that its own words determine (the least
hash among its runs of ``window - 12`` words, the leftmost of equal ones), so equal windows
have equal anchors. Consecutive windows of one anchor are a segment.

Anchors that occur once are done with. Segments equal in all words are one reference entry, at
its first place, and their later places are repeats as a whole. What remains are anchors whose
segments differ: these reference segments are dealt into shards by anchor, each shard builds
the suffix automaton of its segments, streams them through it and removes the windows whose
matching statistics reach ``window`` words that stand earlier. An anchor with more segments than
a shard may hold is taken apart into its windows, which then meet by their own hashes."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk
from .automaton import SuffixAutomaton
from .tables import fresh, small_side, written

NO_ID = -(1 << 63)
# Reference words in one shard's automaton, and the segments of one anchor that may share one.
SHARD_WORDS = 60_000
ANCHOR_SEGMENTS = 2_000
# Neighbouring runs among which a window's anchor is the least.
SLIDE = 13
POSITION_BITS = 26


def _segments(chunk: tk.Chunk, hasher: tk.Hasher, window: int) -> tuple[np.ndarray, ...]:
    """(row, first window, windows, anchor, content) of each segment of the chunk's texts."""
    found = tk.words(chunk, tk.NOT_SPACE)
    hashes = hasher.words(chunk, found)
    slide = min(SLIDE, window)
    n, k = len(hashes), window - slide + 1
    if n < window:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2 + (found, hashes)
    at = np.arange(n - k + 1)
    grams = hasher.grams(hashes, at, at + k)
    least = (grams >> np.uint64(POSITION_BITS) << np.uint64(POSITION_BITS)) | at.astype(np.uint64)
    step = 1
    while 2 * step <= slide:                        # least of 2, 4, 8, then of all neighbours
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if slide > step:
        least = np.minimum(least[:step - slide], least[slide - step:])
    anchor_at = (least & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
    row = found.rows()
    whole = np.flatnonzero(row[:n - window + 1] == row[window - 1:])       # windows within one text
    if not len(whole):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2 + (found, hashes)
    of = anchor_at[whole]
    heads = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (np.diff(whole) != 1)]))
    first = whole[heads]
    count = np.diff(np.concatenate([heads, [len(whole)]]))
    content = hasher.grams(hashes, first, first + count + window - 1)
    return row[first], first - found.first[row[first]], count, grams[of[heads]], content, found, hashes


def _segment_rows(docs: DataFrame, window: int) -> DataFrame:
    """(anchor, content, id, tid, start, n) of every segment of ``docs`` (id, tid, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = tk.Hasher(seed=31)
        for batch in batches:
            ids, tids = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            for chunk in tk.chunks(batch.column(2)):
                row, start, n, anchor, content, _, _ = _segments(chunk, hasher, window)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)),
                                                  pa.array(ids[chunk.low + row]), pa.array(tids[chunk.low + row]),
                                                  pa.array(start, pa.int32()), pa.array(n, pa.int32())],
                                                 ["anchor", "content", "id", "tid", "start", "n"])

    return docs.mapInArrow(run, "anchor long, content long, id long, tid long, start int, n int")


def _take_words(docs: DataFrame, wanted: DataFrame, window: int, several: bool) -> DataFrame:
    """``wanted`` (anchor, id, tid, start, n) with the words of each segment: text."""
    per_doc = written(wanted.groupBy(*DOC).agg(F.collect_list(F.struct("anchor", "start", "n")).alias("segments")), "substring-wanted")
    ids = written(per_doc.select(*DOC), "substring-ids")
    texts = docs.join(small_side(ids), DOC, "left_semi")
    if several:                                              # of rows that repeat exactly one is read
        texts = texts.dropDuplicates(DOC)
    texts = texts.join(per_doc, DOC)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in tk.chunks(batch.column(2)):
                found = tk.words(chunk, tk.NOT_SPACE)
                out: dict[str, list] = {c: [] for c in ("anchor", "id", "tid", "start", "n", "text")}
                for r in range(chunk.high - chunk.low):
                    i, t = (batch.column(c)[chunk.low + r].as_py() for c in (0, 1))
                    for s in batch.column(3)[chunk.low + r].as_py():
                        a = found.first[r] + s["start"]
                        text = chunk.data[found.starts[a]:found.ends[a + s["n"] + window - 2]].tobytes()
                        for c, v in (("anchor", s["anchor"]), ("id", i), ("tid", t), ("start", s["start"]), ("n", s["n"]), ("text", text)):
                            out[c].append(v)
                yield pa.RecordBatch.from_pydict(out, schema)

    schema = pa.schema([("anchor", pa.int64()), ("id", pa.int64()), ("tid", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("text", pa.binary())])
    return texts.select(*DOC, "text", "segments").mapInArrow(run, "anchor long, id long, tid long, start int, n int, text binary")


# Which text a place is in.
DOC = ["id", "tid"]
SEPARATE = re.compile(rb"[^\x20\x09-\x0D]+")


def repeats_in_shard(segments: pd.DataFrame, window: int) -> pd.DataFrame:
    """(id, tid, start, n): runs of windows of the shard's segments that stand earlier in it."""
    segments = segments.sort_values(["id", "start", "tid"], kind="stable")
    sam = SuffixAutomaton()
    read = [(i, t, s, SEPARATE.findall(x)) for i, t, s, x in zip(
        segments["id"], segments["tid"], segments["start"], segments["text"], strict=True)]
    ends = [sam.add(ws) for _, _, _, ws in read]
    top = [0] * len(sam.length)
    for v in sam.parents_first():
        if sam.length[v] >= window:
            up = sam.link[v]
            top[v] = top[up] if sam.length[up] >= window else v
    first: dict[int, tuple[int, int]] = {}
    for (i, _, s, _), states in zip(read, ends, strict=True):
        for j, v in enumerate(states[window - 1:]):
            first.setdefault(top[v], (i, s + j))            # in order, so the first place stays
    out = []
    for i, t, s, ws in read:
        run = None
        for j, (state, matched) in enumerate(sam.matches(ws)):
            place = s + j - window + 1
            if matched >= window and first[top[state]] < (i, place):
                if run and run[2] + run[3] == place:
                    run[3] += 1
                else:
                    run = [i, t, place, 1]
                    out.append(run)
    return pd.DataFrame(out, columns=["id", "tid", "start", "n"]).astype({"id": "int64", "tid": "int64", "start": "int32", "n": "int32"})


def _later(rows: DataFrame, key: list[str]) -> DataFrame:
    """The rows that stand after another one with the same key."""
    place = F.struct("id", "start")
    firsts = written(rows.groupBy(*key).agg(F.min(place).alias("first")), "substring-firsts")
    return rows.join(firsts, key).filter(F.struct("id", "start") > F.col("first")).select("id", "tid", "start", "n")


def _contested(docs: DataFrame, entries: DataFrame, window: int, several: bool) -> DataFrame | None:
    """(id, tid, start, n): repeats among reference entries that share an anchor but not all words."""
    sizes = entries.groupBy("anchor").agg(F.count("*").alias("c")).filter("c > 1")
    wanted = written(entries.join(sizes, "anchor"), "substring-contested")
    total = wanted.agg(F.sum(F.col("n") + window - 1)).first()[0]
    if not total:
        return None
    shards = math.ceil(total / SHARD_WORDS)
    texts = written(_take_words(docs, wanted, window, several), "substring-texts")
    crowded = written(wanted.filter(F.col("c") > ANCHOR_SEGMENTS).select("anchor").distinct(), "substring-crowded")
    schema = T.StructType([f for f in texts.schema.fields if f.name in ("id", "tid", "start", "n")])
    usual = texts if crowded.isEmpty() else texts.join(small_side(crowded), "anchor", "left_anti")
    found = usual.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard").applyInPandas(
        lambda segments: repeats_in_shard(segments, window), schema)
    if crowded.isEmpty():
        return found

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = tk.Hasher(seed=31)
        for batch in batches:
            ids, tids, starts = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2, 3))
            for chunk in tk.chunks(batch.column(5)):
                found = tk.words(chunk, tk.NOT_SPACE)
                at, end, row = tk.shingle_starts(found, window)
                own = hasher.grams(hasher.words(chunk, found), at, end)
                r = chunk.low + row
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.view(np.int64)), pa.array(ids[r]), pa.array(tids[r]),
                     pa.array((starts[r] + at - found.first[row]).astype(np.int32)), pa.array(np.ones(len(row), np.int32))],
                    ["own", "id", "tid", "start", "n"])

    windows = written(texts.join(small_side(crowded), "anchor", "left_semi").select("anchor", "id", "tid", "start", "n", "text")
                      .mapInArrow(apart, "own long, id long, tid long, start int, n int"), "substring-windows")
    return found.union(_later(windows, ["own"]))


def repeated_windows(docs: DataFrame, window: int, several: bool) -> DataFrame:
    """(id, tid, start, n): runs of ``n`` windows from word ``start`` on that stand earlier."""
    rows = _segment_rows(docs, window)
    shared = written(rows.groupBy("anchor").agg(F.count("*").alias("c")).filter("c > 1").select("anchor"), "substring-anchors")
    kept = written(rows.join(shared.hint("merge"), "anchor"), "substring-segments")
    key = ["anchor", "content"]
    entries = kept.groupBy(*key).agg(F.min(F.struct("id", "start", "tid", "n")).alias("e")).select("anchor", "e.*")
    found = _contested(docs, entries, window, several)
    later = _later(kept, key)
    return later if found is None else later.union(found)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20,
                    name: str = "substrings") -> DataFrame:
    """(the columns of ``docs``, with the struct ``name``): n_words, n_removed, removed
    (maximal spans of removed words) and kept (the words that stay, joined by one space).

    Words are runs of anything but ASCII white space. Windows are judged on the input; earlier
    means a smaller doc_id, or the same doc_id and an earlier start. Texts with fewer words than
    a window, empty and null ones keep all they have (kept is empty, not null). A null doc_id
    ranks below every other. Rows that repeat exactly are the same document and get equal
    results; different texts under one doc_id compare by start only. A column of ``docs`` of
    that name is replaced. An empty table gives an empty result. Words and
    windows are known by 64-bit hashes, reference segments by anchor and content, 128 bits."""
    docs = docs.drop(name)
    holder, twin, marked = fresh(docs, "holder"), fresh(docs, "twin"), fresh(docs, "marks")
    own_id = F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))
    # Texts are told apart only where an id does not: what is gathered is gathered for one text.
    ids = docs.select(own_id.alias("id"))
    several = not ids.groupBy("id").agg(F.count("*").alias("c")).filter(f"c > 1 OR id = {NO_ID}").isEmpty()
    own_text = F.xxhash64(F.coalesce(F.col(text), F.lit(""))) if several else F.lit(0).cast("long")
    slim = docs.select(own_id.alias("id"), own_text.alias("tid"), F.col(text).alias("text"))
    marks = repeated_windows(slim, window, several).groupBy(*DOC).agg(
        F.collect_set(F.struct("start", "n")).alias(marked)).withColumnsRenamed({"id": holder, "tid": twin})
    joined = docs.join(marks, (own_id == F.col(holder)) & (own_text == F.col(twin)), "left")
    at = docs.columns.index(text)
    report = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
                           T.StructField("kept", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()),
                          ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string())])
        for batch in batches:
            out = []
            for chunk in tk.chunks(batch.column(at)):
                found = tk.words(chunk, tk.NOT_SPACE)
                for r in range(chunk.high - chunk.low):
                    n = int(found.first[r + 1] - found.first[r])
                    marks, spans = batch.column(len(docs_columns))[chunk.low + r], []
                    if marks.is_valid:
                        starts, counts = (p.to_numpy(zero_copy_only=False) for p in marks.values.flatten())
                        order = np.argsort(starts, kind="stable")
                        for a, b in zip(starts[order].tolist(), (starts + counts + window - 1)[order].tolist(), strict=True):
                            if spans and a <= spans[-1][1]:
                                spans[-1][1] = max(spans[-1][1], b)
                            else:
                                spans.append([a, b])
                    words, kept, end = chunk.text(r).split(), [], 0
                    for a, b in spans:
                        kept += words[end:a]
                        end = b
                    kept += words[end:]
                    out.append({"n_words": n, "n_removed": n - len(kept), "removed": [{"start": a, "end": b} for a, b in spans],
                                "kept": b" ".join(kept).decode()})
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, kind)], [*docs_columns, name])

    docs_columns = docs.columns
    return joined.select(*docs_columns, marked).mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, report)]))
