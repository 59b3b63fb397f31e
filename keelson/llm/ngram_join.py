"""Jaccard similarity join on word n-grams with PartEnum signatures.

Sets are put into bands by size. Two sets with similarity of at least num/den differ in at most
k = (|a| + |b|) (den - num) / (den + num) features. In each band the feature domain is dealt into
n1 > k partitions by hash; k differing features touch at most k partitions, so at least n1 - k
partitions hold the same features in both sets. A set's signatures are the hashes of its
partitions, so sufficiently similar sets share one. A set near the end of its band also emits
the signatures of the next band, whose larger sets it may match.

With spare = n1 - k - 1 a set may leave out its ``spare`` partitions with the fewest features:
of the partitions that two similar sets share, at least one is not among them, and whether a
shared partition is left out depends only on its count, which is the same in both. So
signatures of no or few features, which dissimilar sets share by chance, are hardly ever made,
and no similar pair is lost."""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk
from .components import components
from .tables import fresh, small_side, written


# Groups of up to so many nodes are joined pair by pair; larger ones in chunks of so many nodes.
SMALL_GROUP, CHUNK_NODES = 8, 400


@dataclass
class PartEnum:
    num: int = 90
    den: int = 100
    growth: float = 1.25       # of the bands
    spare_share: float = 0.15
    lows: list[int] = field(default_factory=lambda: [1])

    def band(self, size: int) -> int:
        while self.lows[-1] <= size:
            self.lows.append(max(self.lows[-1] + 1, int(self.lows[-1] * self.growth)))
        return bisect.bisect_right(self.lows, size) - 1

    def shape(self, band: int) -> tuple[int, int]:
        """(partitions, spare) of a band; no partitions where only equal sets are similar."""
        k = 2 * (self.lows[band + 1] - 1) * (self.den - self.num) // (self.den + self.num)
        spare = max(1, round(self.spare_share * (k + 1)))
        return (k + 1 + spare if k else 0), spare

    def signatures(self, features: np.ndarray) -> np.ndarray:
        """Of a sorted set of 64-bit hashes."""
        out = []
        size = len(features)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(tk.mix(features ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1:])
        for band in range(self.band(size), self.band(size * self.den // self.num) + 1):
            n, spare = self.shape(band)
            if not n:
                continue
            part = ((features >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)    # in order, as the features are
            edges = np.searchsorted(part, np.arange(n + 1, dtype=np.uint64))
            counts = np.diff(edges)
            kept = np.flatnonzero(counts >= np.partition(counts, spare)[spare])
            salt = tk.mix(kept.astype(np.uint64) + np.uint64((band + 1) << 40))
            out.append(tk.mix(sums[edges[kept + 1]] - sums[edges[kept]] + salt))
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_sets(column: pa.Array, n: int, hasher: tk.Hasher) -> Iterator[np.ndarray]:
    """The sorted distinct ``n``-word shingles of each text, as hashes. A-Z are lower-cased; words
    are runs of anything but ASCII white space; fewer than ``n`` words are one shingle."""
    for chunk in tk.chunks(column):
        found = tk.words(chunk, tk.NOT_SPACE)
        starts, ends, row = tk.shingle_starts(found, n)
        grams = hasher.grams(hasher.words(chunk, found), starts, ends)
        cuts = np.searchsorted(row, np.arange(len(found.first)))
        for r in range(len(found.first) - 1):
            g = np.sort(grams[cuts[r]:cuts[r + 1]])
            yield g[np.concatenate([[True], g[1:] != g[:-1]])] if len(g) > 1 else g


def fingerprint(features: np.ndarray) -> int:
    """A 64-bit hash of the set."""
    total = int(np.add.reduce(tk.mix(features ^ np.uint64(0x2545F4914F6CDD1D)), dtype=np.uint64))
    one = tk.mix(np.array([total ^ (len(features) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)], np.uint64))
    return int(one.view(np.int64)[0])


def sketch(features: np.ndarray) -> bytes:
    """For each bit position, whether an odd number of features hashes to it. Two sketches differ
    in no more bits than the sets do in features: a check that needs no sets and loses no pair.
    About two to four bits a feature, a power of two; longer sketches fold onto shorter ones."""
    bits = max(256, 1 << (2 * len(features) - 1).bit_length())
    odd = np.bincount((features & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def sketch_distance(x: bytes, y: bytes) -> int:
    a, b, n, m = int.from_bytes(x), int.from_bytes(y), len(x), len(y)
    while n > m:
        n //= 2
        a = (a >> 8 * n) ^ (a & (1 << 8 * n) - 1)
    while m > n:
        m //= 2
        b = (b >> 8 * m) ^ (b & (1 << 8 * m) - 1)
    return (a ^ b).bit_count()


def profiles(docs: DataFrame, doc_id: str, text: str, n: int) -> DataFrame:
    """(doc_id, n_shingles, fp, sketch) of every row; fp is null for the empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = tk.Hasher(seed=21, fold=True)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                rows = [(len(f), fingerprint(f), sketch(f)) if len(f) else (0, None, None)
                        for f in shingle_sets(part.column(1), n, hasher)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.binary())], ["doc_id", "n_shingles", "fp", "sketch"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, fp long, sketch binary")


def signature_rows(docs: DataFrame, text: str, n: int, scheme: PartEnum) -> DataFrame:
    """(fp, n, sig) of every set's signatures, once for each task that meets the set: copies add
    no rows within a task."""
    num, den, growth, spare_share = scheme.num, scheme.den, scheme.growth, scheme.spare_share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, enum = tk.Hasher(seed=21, fold=True), PartEnum(num, den, growth, spare_share)
        seen: set[int] = set()
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part, found = batch.slice(low, 512), []
                for f in shingle_sets(part.column(0), n, hasher):
                    if len(f) and (fp := fingerprint(f)) not in seen:
                        seen.add(fp)
                        found.append((fp, len(f), enum.signatures(f)))
                counts = [len(x[2]) for x in found]
                sigs = np.concatenate([x[2] for x in found]).view(np.int64) if found else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array([x[0] for x in found], np.int64), counts)),
                     pa.array(np.repeat(np.array([x[1] for x in found], np.int64), counts)), pa.array(sigs)], ["fp", "n", "sig"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "fp long, n long, sig long")


def feature_rows(docs: DataFrame, n: int) -> DataFrame:
    """(fp, features) of ``docs`` (text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = tk.Hasher(seed=21, fold=True)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                sets = [s for s in shingle_sets(batch.slice(low, 256).column(0), n, hasher) if len(s)]
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([fingerprint(s) for s in sets], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["fp", "features"])

    return docs.select("text").mapInArrow(run, "fp long, features array<long>")


def _fits(n_a: Column, n_b: Column, s: PartEnum) -> Column:
    return F.least(n_a, n_b) * s.den >= F.greatest(n_a, n_b) * s.num


def _linked(pairs: DataFrame, sets: DataFrame, s: PartEnum) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough: the exact check."""
    left = sets.select(F.col("fp").alias("a"), F.col("features").alias("x"))
    right = sets.select(F.col("fp").alias("b"), F.col("features").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", both.alias("i"), (F.size("x") + F.size("y")).alias("t"))
            .filter(F.col("i") * s.den >= (F.col("t") - F.col("i")) * s.num).select("a", "b"))


def similar_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 3, num: int = 90, den: int = 100,
                   growth: float | None = None, sets: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``: component_id is the
    smallest doc_id reachable by links, which join rows whose sets of ``n``-word shingles have a
    Jaccard similarity of num/den or more.

    Null and empty texts have the empty set, link with nothing and are their own component. Rows
    with equal sets are one node, so copies cost one row each and no pairs; repeated rows are
    copies. A null doc_id takes part, but never names a component unless nothing else does (then
    it is null). An empty table gives an empty result. Sets are known by 64-bit hashes; with ``sets``
    there are also fp, the set's hash, and label, the same for all sets of a component.

    Nodes that share a signature are checked against one of them, the hub, first. Only where the
    links found so far leave the nodes of a signature in several components are further pairs
    checked, across components only (see ``_across``)."""
    scheme = PartEnum(num, den, growth or max(1.25, (den / num) ** 2))
    rows = written(profiles(docs, doc_id, text, n), "ngram-profiles")
    # Members of the signatures that several nodes share, without each one's first node, the hub.
    w = Window.partitionBy("sig").orderBy("fp")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shared = (signature_rows(docs, text, n, scheme)
              .withColumns({"hub": F.first("fp").over(running), "hub_n": F.first("n").over(running),
                            "prev": F.lag("fp").over(w)})
              .filter("fp != hub AND fp != prev").drop("prev"))
    members = written(shared, "ngram-members")
    nodes = members.select("fp").union(members.select("hub")).distinct()
    sketches = written(rows.join(nodes, "fp", "left_semi").groupBy("fp").agg(
        F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "ngram-sketches")
    classes = rows.filter("fp IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("least"))
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))

    def sets_of(few: DataFrame) -> DataFrame:
        """(fp, features) of the nodes ``few`` (fp), read from one text of each."""
        ids = written(classes.join(few, "fp", "left_semi").select("least").distinct(), "ngram-wanted")
        found = feature_rows(texts.join(small_side(ids), F.col("id").eqNullSafe(F.col("least")), "left_semi"), n)
        return written(found.join(few, "fp", "left_semi").dropDuplicates(["fp"]), "ngram-sets")

    tested = written(_near(members.filter(_fits(F.col("n"), F.col("hub_n"), scheme))
                           .select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct(), sketches, scheme), "ngram-pairs")
    features = sets_of(written(tested.select(F.col("a").alias("fp")).union(tested.select("b")).distinct(), "ngram-tested"))
    links = written(_linked(tested, features, scheme), "ngram-links")
    labels = written(components(links), "ngram-labels")
    more = _across(members, labels, sketches, sets_of, scheme)
    if more is not None:
        labels = written(components(links.union(more)), "ngram-labels")
    named = classes.join(labels, classes["fp"] == labels["node"]).select("fp", "label", "least")
    names = named.groupBy("label").agg(F.min("least").alias("component"))
    # A table of its own, so that the join splits the partition of a set with very many copies.
    by_set = written(classes.join(named.join(names, "label").select("fp", "component", "label"), "fp", "left").select(
        F.col("fp").alias("set"), F.coalesce("component", "least").alias("component"), F.coalesce("label", "fp").alias("label")),
        "ngram-names")
    return (rows.select("doc_id", "n_shingles", "fp").join(by_set, F.col("fp") == F.col("set"), "left")
            .select("doc_id", "n_shingles", F.when(F.col("fp").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component")).alias("component_id"), *(["fp", "label"] if sets else [])))


def _near(pairs: DataFrame, sketches: DataFrame, s: PartEnum) -> DataFrame:
    """The pairs (a, b) whose sketches allow them to be similar."""
    left = sketches.select(F.col("fp").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("x"))
    right = sketches.select(F.col("fp").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("y"))
    num, den = s.num, s.den

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "x", "y")), strict=True)
            near = [sketch_distance(x, y) * (den + num) <= (n_a + n_b) * (den - num) for n_a, n_b, x, y in rows]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "x", "y").mapInArrow(run, "a long, b long")


def _across(members: DataFrame, labels: DataFrame, sketches: DataFrame, sets_of: Callable[[DataFrame], DataFrame],
            s: PartEnum) -> DataFrame | None:
    """Further links (a, b), enough to connect whatever similar pairs share a signature.

    The nodes of all signatures with one hub form a group if they are in several components. In
    a group, nodes outside its largest component (the strays) are checked against all its nodes.
    Small groups are joined; large ones are dealt into chunks, and each pair of chunks is one
    matrix product in a task that returns a spanning forest: no pairs are made, and no task
    holds more than two chunks. Sketches go first; only nodes that are near one of another
    component by their sketches have their sets read."""
    everyone = members.select("sig", "fp").union(members.select("sig", "hub").distinct())
    known = written(everyone.join(labels, F.col("fp") == F.col("node"), "left").select(
        "sig", "fp", F.coalesce("label", "fp").alias("label")), "ngram-known")
    mixed = known.groupBy("sig").agg(F.count("*").alias("c"), F.min("label").alias("x"), F.max("label").alias("y")) \
        .filter("c > 2 AND x != y").select("sig")
    # A group is named by the hub of its signatures, which any two nodes of one signature share.
    mates = written(members.join(mixed, "sig", "left_semi").select(F.col("hub").alias("g"), "fp").distinct(), "ngram-mates")
    if mates.isEmpty():
        return None
    nodes = mates.union(mates.select("g", "g").distinct()).join(labels, F.col("fp") == F.col("node"), "left").select(
        "g", "fp", F.coalesce("label", "fp").alias("label"))
    largest = nodes.groupBy("g", "label").agg(F.count("*").alias("c")).groupBy("g").agg(
        F.sum("c").alias("m"), F.max(F.struct("c", "label")).alias("main"))
    grouped = written(nodes.join(largest, "g").filter("m > main.c").select(
        "g", "fp", "label", "m", (F.col("label") != F.col("main.label")).alias("stray"), (F.col("m") - F.col("main.c")).alias("strays")),
        "ngram-groups")
    small = grouped.filter(F.col("m") <= SMALL_GROUP)
    pairs = (small.filter("stray").select("g", F.col("fp").alias("a"), "label").join(
        small.select("g", F.col("fp").alias("b"), F.col("label").alias("label_b")), "g")
        .filter("label != label_b").select("a", "b").distinct())
    pairs = written(_near(pairs, sketches, s), "ngram-pairs")
    few = pairs.select(F.col("a").alias("fp")).union(pairs.select("b"))
    large = written(grouped.filter(F.col("m") > SMALL_GROUP), "ngram-large")
    if large.isEmpty():
        return written(_linked(pairs, sets_of(written(few.distinct(), "ngram-few")), s), "ngram-links")
    num, den = s.num, s.den
    near = written(_cells(large.join(sketches, "fp"), ["n", "sketch"], lambda key, left, right: near_nodes(
        left, right, num, den), "g long, fp long").distinct(), "ngram-near")
    sets = sets_of(written(few.union(near.select("fp")).distinct(), "ngram-few"))
    links = _linked(pairs, sets, s)
    chosen = large.join(near, ["g", "fp"]).join(sets, "fp")
    found = _cells(chosen, ["features"], lambda key, left, right: spanning_links(left, right, num, den), "a long, b long")
    return written(links.union(found), "ngram-links")


def _cells(dealt: DataFrame, payload: list[str], run: Callable, schema: str) -> DataFrame:
    """``run`` on each pair of chunks of each group: strays on the left, all nodes on the right."""
    chunk = lambda n: F.ceil(F.col(n) / CHUNK_NODES).cast("int")
    deal = lambda n: F.pmod(F.xxhash64("fp"), F.col(n)).cast("int")
    dealt = dealt.withColumn("ni", chunk("strays")).withColumn("nj", chunk("m"))
    rows = dealt.filter("stray").withColumns({"i": deal("ni"), "j": F.explode(F.sequence(F.lit(0), F.col("nj") - 1))})
    others = dealt.withColumns({"j": deal("nj"), "i": F.explode(F.sequence(F.lit(0), F.col("ni") - 1))})
    # Aliases, as both sides come from one table.
    cells = [x.select(*[F.col(c).alias(c) for c in ("g", "i", "j", "fp", "label", *payload)]).groupBy("g", "i", "j")
             for x in (rows, others)]
    return cells[0].cogroup(cells[1]).applyInPandas(run, schema)


def near_nodes(left: pd.DataFrame, right: pd.DataFrame, num: int, den: int) -> pd.DataFrame:
    """(g, fp) of the nodes (fp, label, n, sketch) of two chunks that are near a node of another
    component by their sketches."""
    hit: set[int] = set()
    bits = [{}, {}]
    for side, df in enumerate((left, right)):
        lengths = df["sketch"].str.len().to_numpy()
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            raw = np.frombuffer(b"".join(df["sketch"].iloc[at]), np.uint8).reshape(len(at), length)
            bits[side][int(length)] = (at, np.unpackbits(raw, axis=1))
    n, labels, fps = ([df[c].to_numpy() for df in (left, right)] for c in ("n", "label", "fp"))
    for la, (ia, xa) in bits[0].items():
        for lb, (ib, xb) in bits[1].items():
            if max(la, lb) > 4 * min(la, lb) * -(-den // num):
                continue                                    # too different in size
            width = 8 * min(la, lb)
            x, y = ((z.reshape(len(z), -1, width).sum(1) & 1).astype(np.float32) for z in (xa, xb))
            apart = x.sum(1)[:, None] + y.sum(1)[None, :] - 2 * (x @ y.T)
            total, least = n[0][ia][:, None] + n[1][ib][None, :], np.minimum(n[0][ia][:, None], n[1][ib][None, :])
            close = ((apart * (den + num) <= total * (den - num)) & (least * den >= (total - least) * num)
                     & (labels[0][ia][:, None] != labels[1][ib][None, :]))
            hit.update(fps[0][ia[close.any(1)]].tolist())
            hit.update(fps[1][ib[close.any(0)]].tolist())
    g = int(left["g"].iloc[0]) if len(left) else 0
    return pd.DataFrame({"g": [g] * len(hit), "fp": list(hit)}).astype("int64")


def shared_counts(left: list[np.ndarray], right: list[np.ndarray], width: int = 2048) -> np.ndarray:
    """How many features each set on the left shares with each on the right: products of 0/1
    matrices over ``width`` features at a time."""
    flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right)]
    both = np.intersect1d(*flat)
    out = np.zeros((len(left), len(right)), np.float32)
    sides = []
    for sets, values in zip((left, right), flat, strict=True):
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.minimum(np.searchsorted(both, values), max(len(both) - 1, 0))
        ok = both[at] == values if len(both) else np.zeros(len(values), bool)
        order = np.argsort(at[ok], kind="stable")
        sides.append((row[ok][order], at[ok][order]))
    for low in range(0, len(both), width):
        parts = []
        for sets, (row, at) in zip((left, right), sides, strict=True):
            a, b = np.searchsorted(at, [low, low + width])
            x = np.zeros((len(sets), width), np.float32)
            x[row[a:b], at[a:b] - low] = 1
            parts.append(x)
        out += parts[0] @ parts[1].T
    return out


def spanning_links(left: pd.DataFrame, right: pd.DataFrame, num: int, den: int) -> pd.DataFrame:
    """Links between similar nodes (fp, label, features) of two chunks that join components which
    neither the labels nor earlier links of the chunks join."""
    out: list[tuple[int, int]] = []
    if len(left) and len(right):
        sizes = [np.array([len(x) for x in side["features"]], np.float32) for side in (left, right)]
        shared = shared_counts(list(left["features"]), list(right["features"]))
        close = np.argwhere(shared * den >= (sizes[0][:, None] + sizes[1][None, :] - shared) * num)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        fps, labels = ([side[c].to_numpy() for side in (left, right)] for c in ("fp", "label"))
        for i, j in close:
            a, b = root(int(labels[0][i])), root(int(labels[1][j]))
            if a != b:
                parent[a] = b
                out.append((int(fps[0][i]), int(fps[1][j])))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _fingerprinted(docs: DataFrame, text: str, n: int, name: str) -> DataFrame:
    """``docs`` with the hash of each row's set as the column ``name``, null for the empty set."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = tk.Hasher(seed=21, fold=True)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                fps = [fingerprint(f) if len(f) else None for f in shingle_sets(part.column(at), n, hasher)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(fps, pa.int64())], [*part.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def drop_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5, num: int = 80, den: int = 100,
                 **options) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id, with all
    columns. Where a doc_id stands on several rows, each goes or stays by its own text: of those
    in one group one stays, and texts that do not link stay each. Rows without doc_id stay, those
    with one set of shingles once; empty texts link with nothing, so all of these stay."""
    loser, held, mark = (fresh(docs, x) for x in ("loser", "held", "mark"))
    groups = written(similar_groups(docs, doc_id, text, n, num, den, sets=True, **options), "ngram-groups")
    losers = written(groups.filter("component_id != doc_id").select(F.col("doc_id").alias(loser)).distinct(), "ngram-losers")
    repeated = written(groups.groupBy("doc_id").agg(F.count("*").alias("c")).filter("c > 1").select(F.col("doc_id").alias(loser)), "ngram-repeated")
    if repeated.isEmpty():
        return docs.join(small_side(losers), docs[doc_id] == F.col(loser), "left_anti")
    named = repeated.filter(F.col(loser).isNotNull())
    known = docs.filter(F.col(doc_id).isNotNull())
    gone = written(losers.union(named).distinct(), "ngram-gone")
    once = known.join(small_side(gone), known[doc_id] == F.col(loser), "left_anti")
    # One set of each group that a repeated doc_id names; groups are told apart by label.
    stays = (groups.filter("component_id = doc_id").join(named, F.col("doc_id") == F.col(loser), "left_semi")
             .groupBy("doc_id", "label").agg(F.min("fp").alias("fp")).select(F.col("doc_id").alias(loser), F.col("fp").alias(held)))
    again = _fingerprinted(known.join(named, known[doc_id] == F.col(loser), "left_semi"), text, n, mark).dropDuplicates([doc_id, mark])
    again = again.join(stays, (again[doc_id] == F.col(loser)) & again[mark].eqNullSafe(F.col(held)), "left_semi")
    unnamed = _fingerprinted(docs.filter(F.col(doc_id).isNull()), text, n, mark)
    unnamed = unnamed.filter(F.col(mark).isNull()).union(unnamed.filter(F.col(mark).isNotNull()).dropDuplicates([mark]))
    return once.union(again.drop(mark)).union(unnamed.drop(mark))
