"""Benchmark decontamination with a generalised suffix automaton of the test items.

Documents stream through the automaton, which tracks the longest run of words so far that also
stands in an item. Where the run reaches a window (``window`` words, or a shorter item as a
whole), those words are hit. Spans of hit words and their share of the document decide.

The automaton is broadcast; its size is bounded by ``block_words``. A larger benchmark is dealt
into blocks, each with an automaton of its own, that pass over the documents in turn."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk
from .automaton import SuffixAutomaton
from .tables import fresh, written

# Words in one automaton: about 100 MB in the driver and in each Python worker.
BLOCK_WORDS = 150_000
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
REPORT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("longest", T.LongType()),
    T.StructField("spans", T.ArrayType(SPAN)), T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("cleaned", T.StringType())])


def tokens(text: str | None) -> list[bytes]:
    """A-Z lower-cased; words are runs of ASCII letters, digits and all non-ASCII characters."""
    table = bytes(b if tk.ALNUM[b] else 0x20 for b in tk.LOWER)
    return (text or "").encode().translate(table).split()


class Benchmark:
    """The automaton of some items and what its states tell."""

    def __init__(self, items: list[tuple[str, str]], window: int = 13):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.automaton = SuffixAutomaton()
        ends: list[tuple[str, int, list[int]]] = []
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in tokens(text)]
            if ids:
                ends.append((item, len(ids), self.automaton.add(ids)))
        self.shortest = min([window, *(n for _, n, _ in ends)]) if ends else 0
        sam = self.automaton
        # Of each state: the state of its last ``window`` words, and the items that hold them.
        self.top = [0] * len(sam.length)
        for v in sam.parents_first():
            if sam.length[v] >= window:
                up = sam.link[v]
                self.top[v] = self.top[up] if sam.length[up] >= window else v
        self.items: dict[int, set[str]] = {}
        short: dict[int, list[tuple[int, str]]] = {}
        for item, n, states in ends:
            if n < window:
                short.setdefault(sam.holder(states[-1], n), []).append((n, item))
            for v in states[window - 1:]:
                self.items.setdefault(self.top[v], set()).add(item)
        # Of each state: the short items that end its strings.
        self.short: dict[int, list[tuple[int, str]]] = {}
        if short:
            for v in sam.parents_first():
                if own := self.short.get(sam.link[v], []) + short.get(v, []):
                    self.short[v] = own

    def scan(self, ids: list[int]) -> tuple[list[tuple[int, int]], set[str], int]:
        """Spans of hit words, the items met and the longest match."""
        spans: list[list[int]] = []
        items: set[str] = set()
        longest = 0
        for i, (state, matched) in enumerate(self.automaton.matches(ids)):
            longest = max(longest, matched)
            size = 0
            if matched >= self.window:
                size = self.window
                items |= self.items[self.top[state]]
            for n, item in self.short.get(state, ()):
                if n <= matched:
                    size = max(size, n)
                    items.add(item)
            if size:
                start = i + 1 - size
                while spans and start <= spans[-1][1]:
                    start = min(start, spans.pop()[0])
                spans.append([start, i + 1])
        return [(a, b) for a, b in spans], items, longest


class Scanner:
    """Finds the runs of benchmark words long enough for a window and scans those: between them
    the match is shorter than any window, so nothing is missed."""

    def __init__(self, bench: Benchmark):
        self.bench, self.hasher = bench, tk.Hasher(seed=11, fold=True)
        blob = pa.array([b" ".join(bench.vocabulary)], pa.binary())
        chunk = next(tk.chunks(blob))
        self.known = np.sort(self.hasher.words(chunk, tk.words(chunk, tk.ALNUM)))
        self.rough = np.zeros(1 << 16, bool)
        self.rough[(self.known >> np.uint64(48)).astype(np.int64)] = True

    def rows(self, chunk: tk.Chunk) -> Iterator[tuple[int, list[tuple[int, int]], set[str], int, list[tuple[int, int]]]]:
        """(n_words, spans in words, items, longest, spans in bytes) of each row."""
        found = tk.words(chunk, tk.ALNUM)
        hashes = self.hasher.words(chunk, found)
        member = self.rough[(hashes >> np.uint64(48)).astype(np.int64)]
        at = np.flatnonzero(member)
        if len(self.known):
            near = np.searchsorted(self.known, hashes[at])
            at = at[self.known[np.minimum(near, len(self.known) - 1)] == hashes[at]]
        else:
            at = at[:0]
        # Runs of consecutive known words within a row.
        row = np.searchsorted(found.first, at, "right") - 1
        cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(row) != 0)) + 1
        heads = np.concatenate([[0], cut]) if len(at) else np.zeros(0, np.int64)
        sizes = np.diff(np.concatenate([heads, [len(at)]]))
        long = sizes >= max(self.bench.shortest, 1)
        runs: dict[int, list[tuple[int, int]]] = {}
        for h, n in zip(heads[long].tolist(), sizes[long].tolist(), strict=True):
            runs.setdefault(int(row[h]), []).append((int(at[h]), n))
        vocabulary, counts = self.bench.vocabulary, np.diff(found.first).tolist()
        for r, n_words in enumerate(counts):
            spans, items, longest, where = [], set(), 0, []
            for start, n in runs.get(r, ()):
                text = chunk.data[found.starts[start]:found.ends[start + n - 1]].tobytes()
                ids = [vocabulary.get(w, 0) for w in tokens(text.decode("utf-8", "replace"))]
                got, some, most = self.bench.scan(ids)
                first = int(found.first[r])
                spans += [(start - first + a, start - first + b) for a, b in got]
                where += [(int(found.starts[start + a] - chunk.offsets[r]), int(found.ends[start + b - 1] - chunk.offsets[r])) for a, b in got]
                items |= some
                longest = max(longest, most)
            yield n_words, spans, items, longest, where


def _report(docs: DataFrame, bench, text: str, name: str) -> DataFrame:
    """One pass: ``docs`` with the struct ``name`` from one block of items."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, REPORT)])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(cloudpickle.loads(bench.value))
        kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("longest", pa.int64()),
                          ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                          ("items", pa.list_(pa.string())), ("cleaned", pa.string())])
        for batch in batches:
            # A batch out for each chunk of text: findings of a whole batch are never held at once.
            for chunk in tk.chunks(batch.column(at)):
                out = []
                for r, (n, spans, items, longest, where) in enumerate(scanner.rows(chunk)):
                    cleaned = None
                    if where:
                        raw, kept, end = chunk.text(r), [], 0
                        for a, b in where:
                            kept.append(raw[end:a])
                            end = b
                        cleaned = (b"".join(kept) + raw[end:]).decode()
                    out.append({"n_words": n, "n_hit": sum(b - a for a, b in spans), "longest": longest,
                                "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted(items), "cleaned": cleaned})
                part = batch.slice(chunk.low, chunk.high - chunk.low)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, kind)], [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = 13, block_words: int = BLOCK_WORDS,
                  name: str = "contamination") -> DataFrame:
    """All columns of ``docs`` and the struct ``name``: n_words, n_hit (words in a
    window), longest (words of the longest run that was looked at), spans (of hit words), items
    (ids as strings, sorted) and cleaned (the text without its hit spans; null if there is none).

    Null and empty texts have no words and no hits; items without words have no window; repeated
    items count once, and repeated rows get equal results. A column of ``docs`` of that name is
    replaced. An empty table on either side gives no hits."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text")) \
        .filter("item IS NOT NULL AND text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.size(F.split("text", "[^0-9A-Za-z\\x{80}-\\x{10FFFF}]+")))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_words))
    docs = docs.drop(name)
    more = fresh(docs, name + "_more")
    sc = docs.sparkSession.sparkContext
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        bench = sc.broadcast(cloudpickle.dumps(Benchmark([tuple(r) for r in part.collect()], window)))
        if b == 0:
            docs = _report(docs, bench, text, name)
            continue
        docs = _merge(_report(written(docs, "contamination"), bench, text, more), text)
    return docs


def _merge(docs: DataFrame, text: str) -> DataFrame:
    """The last two columns are the findings of earlier blocks of items and of one more: join
    them into one column; overlapping spans become one."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x, y, body in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(),
                                  batch.column(at).to_pylist(), strict=True):
                spans: list[list[int]] = []
                for a, b in sorted((s["start"], s["end"]) for s in x["spans"] + y["spans"]):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(b, spans[-1][1])
                    else:
                        spans.append([a, b])
                rows.append({"n_words": x["n_words"], "n_hit": sum(b - a for a, b in spans), "longest": max(x["longest"], y["longest"]),
                             "spans": [{"start": a, "end": b} for a, b in spans],
                             "items": sorted({*x["items"], *y["items"]}), "cleaned": _cut(body, spans) if spans else None})
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(rows, batch.column(batch.num_columns - 2).type)], names[:-1])

    return docs.mapInArrow(run, T.StructType(docs.schema.fields[:-1]))


def _cut(body: str, spans: list[list[int]]) -> str:
    chunk = next(tk.chunks(pa.array([body])))
    found, raw, kept, end = tk.words(chunk, tk.ALNUM), chunk.text(0), [], 0
    for a, b in spans:
        kept.append(raw[end:found.starts[a]])
        end = int(found.ends[b - 1])
    return (b"".join(kept) + raw[end:]).decode()


def is_contaminated(name: str = "contamination", percent: int = 5) -> Column:
    """At least one hit, and hits in at least ``percent`` of 100 words."""
    c = F.col(name)
    return (c["n_hit"] > 0) & (100 * c["n_hit"] >= percent * c["n_words"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", percent: int = 5,
                  cut_spans: bool = False, **options) -> DataFrame:
    """The documents below the coverage limit, with the columns of ``docs``; with ``cut_spans``
    the hit spans are also cut from the text of those that stay."""
    name = fresh(docs, "contamination")
    reported = contamination(docs, benchmark, text, name=name, **options).filter(~is_contaminated(name, percent))
    return reported.select(*[F.coalesce(F.col(name)["cleaned"], F.col(f"`{c}`")).alias(c) if cut_spans and c == text
                             else F.col(f"`{c}`") for c in docs.columns])
