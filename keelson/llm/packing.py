"""Best-fit packing of documents into training sequences, under conflicts.

Documents are cut into pieces of at most ``capacity`` words. Pieces are dealt into groups of
bounded size by a salted hash, and each group is packed by itself: longest piece first, into
the bin with the smallest residual that still takes it. Bins are kept in order of residual and
carry bitmaps of the sources and duplicate clusters they hold; the search goes on, past blocks of
bins that all conflict, to the next larger residual until a bin has neither the piece's cluster
nor, with ``one_per_source``, its source. Bins never span groups, so the rules hold for the whole result."""

from __future__ import annotations

import bisect
import math
from collections import Counter
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import whole, words

# Pieces of one group: bounds a task's memory, whatever the corpus.
GROUP_PIECES = 20_000
# Bins of one block in the order of residuals; a block of twice as many is split.
BLOCK = 48
SCHEMA = "bin_id long, position int, doc_id long, piece int, start long, n_words long"


class Bins:
    """Open bins of one group in order of residual space. The order is kept in blocks, each with
    the bitmaps that all its bins share: under a hot source or cluster, a block whose bins all
    hold it is passed over in one step."""

    def __init__(self, capacity: int, block: int = BLOCK):
        self.capacity, self.block, self.count = capacity, block, 0
        self.blocks: list[list[tuple[int, int]]] = []   # (residual, bin)
        self.last: list[tuple[int, int]] = []           # greatest entry by block
        self.shared: list[tuple[int, int]] = []         # sources and clusters by block
        self.sources: list[int] = []                    # bitmaps by bin
        self.clusters: list[int] = []

    def find(self, size: int, source: int, cluster: int) -> tuple[int, int] | None:
        """Block and place of the smallest residual that takes the piece."""
        first = bisect.bisect_left(self.last, (size, -1))
        for i in range(first, len(self.blocks)):
            if self.shared[i][0] & source or self.shared[i][1] & cluster:
                continue
            block = self.blocks[i]
            for k in range(bisect.bisect_left(block, (size, -1)) if i == first else 0, len(block)):
                if not (self.sources[block[k][1]] & source or self.clusters[block[k][1]] & cluster):
                    return i, k
        return None

    def settle(self, i: int) -> None:
        """Bring what is known of block ``i`` up to date; split it if it has grown too large."""
        block = self.blocks[i]
        parts = [block] if len(block) <= 2 * self.block else [block[:self.block], block[self.block:]]
        parts = [x for x in parts if x]
        self.blocks[i:i + 1] = parts
        self.last[i:i + 1] = [x[-1] for x in parts]
        self.shared[i:i + 1] = [(reduce(and_, (self.sources[b] for _, b in x)),
                                 reduce(and_, (self.clusters[b] for _, b in x))) for x in parts]

    def put(self, size: int, source: int, cluster: int) -> int:
        """The bin chosen."""
        found = self.find(size, source, cluster)
        if found:
            residual, b = self.blocks[found[0]].pop(found[1])
            self.sources[b] |= source
            self.clusters[b] |= cluster
            self.settle(found[0])
        else:
            residual, b = self.capacity, self.count
            self.count += 1
            self.sources.append(source)
            self.clusters.append(cluster)
        if residual > size:
            entry = (residual - size, b)
            i = min(bisect.bisect_left(self.last, entry), len(self.blocks) - 1)
            if i < 0:
                self.blocks, self.last, self.shared, i = [[]], [entry], [(0, 0)], 0
            bisect.insort(self.blocks[i], entry)
            self.settle(i)
        return b


def pack_group(pieces: pd.DataFrame, capacity: int, one_per_source: bool) -> pd.DataFrame:
    """bin, position and offset of each piece of one group, longest first."""
    pieces = pieces.sort_values(["n_words", "doc_id", "piece", "cluster", "source"],
                                ascending=[False, True, True, True, True], kind="stable", na_position="first")
    repeats, of_source = Counter(pieces["cluster"]), Counter(pieces["source"])
    sources: dict[object, int] = {}
    clusters: dict[object, int] = {}
    bit = lambda seen, x: 1 << seen.setdefault(x, len(seen))
    bins, out, held = Bins(capacity), [], Counter()
    for size, source, cluster in zip(pieces["n_words"], pieces["source"], pieces["cluster"], strict=True):
        b = bins.put(size, bit(sources, source) if one_per_source and source is not None and of_source[source] > 1 else 0,
                             bit(clusters, cluster) if cluster is not None and repeats[cluster] > 1 else 0)
        out.append((b, held[b]))
        held[b] += 1
    placed = pieces.copy()
    placed["bin"], placed["position"] = [x[0] for x in out], [x[1] for x in out]
    return placed


def pieces_of(docs: DataFrame, capacity: int, doc_id: str = "doc_id", text: str = "text", source: str = "source",
              cluster: Column | None = None) -> DataFrame:
    """(doc_id, piece, start, n_words, source, cluster): whole pieces of ``capacity`` words and the
    rest. The default cluster is the text's hash, so exact copies never share a bin."""
    body = whole(text)
    cluster = F.xxhash64(body) if cluster is None else cluster
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.size(words(body)).cast("long").alias("total"),
                       F.col(source).cast("string").alias("source"), cluster.cast("long").alias("cluster"))
    last = F.greatest(F.ceil(F.col("total") / capacity), F.lit(1)) - 1
    return (slim.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
            .withColumn("start", F.col("piece") * capacity)
            .select("doc_id", F.col("piece").cast("int").alias("piece"), "start",
                    F.least(F.col("total") - F.col("start"), F.lit(capacity)).alias("n_words"), "source", "cluster"))


def pack(docs: DataFrame, capacity: int = 2048, doc_id: str = "doc_id", text: str = "text", source: str = "source",
         cluster: Column | None = None, one_per_source: bool = False, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """(bin_id, position, doc_id, piece, start, n_words): one row for each piece of each document.

    No bin holds more than ``capacity`` words, nor two pieces of one duplicate cluster (so a
    long document's pieces lie in different bins, too), nor with ``one_per_source`` two pieces
    of one source. A null cluster or source conflicts with nothing. Empty and null texts are
    one piece of no words: they take part, so each document has a row. Ties go by doc_id, then
    piece; repeated rows are pieces of their own. An empty table gives an empty result.

    Only slim rows are shuffled. The number of groups follows the number of pieces, which the
    salted hash spreads evenly, also those of one source or cluster."""
    pieces = pieces_of(docs, capacity, doc_id, text, source, cluster)
    groups = max(1, math.ceil(pieces.agg(F.count("*")).first()[0] / group_pieces))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group["source"] = group["source"].where(group["source"].notna(), None)
        group["cluster"] = group["cluster"].astype(object).where(group["cluster"].notna(), None)
        placed = pack_group(group, capacity, one_per_source)
        placed["bin_id"] = (key[0] << 32) + placed["bin"]
        return placed[["bin_id", "position", "doc_id", "piece", "start", "n_words"]]

    salted = pieces.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "n_words"), F.lit(groups)).cast("long"))
    return salted.groupBy("grp").applyInPandas(run, SCHEMA)
