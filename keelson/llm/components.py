"""Connected components of links between 64-bit ids: joined within tasks first, then across them
by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written

# Links that one task joins by itself.
TASK_LINKS = 500_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (a > b). A node's neighbours are linked to the least of them and itself: the
    larger neighbours in a large star, the smaller ones and the node in a small star."""
    if large:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = near.join(least, "u")
    if large:
        out = met.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
    return out.filter("a > b").distinct()


def _forest(edges: DataFrame) -> DataFrame:
    """Each partition's edges (a, b) replaced by (node, least node of its component there)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        if parent:
            yield pa.RecordBatch.from_pydict({"a": list(parent), "b": [root(x) for x in parent]},
                                             pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return edges.mapInArrow(run, "a long, b long")


def components(links: DataFrame, max_rounds: int = 60, task_links: int = TASK_LINKS) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the smallest node it reaches.

    Links may come in either direction, repeat, or join a node to itself. First each task joins
    its own ``task_links`` links; with more than one task, rounds of stars then join the tasks'
    components. Each round writes its edges to the shared folder, so lineage stays short; only
    counts and a checksum reach the driver. Rounds grow with the logarithm of the longest path."""
    def kept(df: DataFrame) -> DataFrame:
        return written(df.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")), "components")

    edges = kept(links)
    tasks = max(1, -(-edges.count() // task_links))
    local = kept(_forest(edges.coalesce(tasks)))
    if edges.coalesce(tasks).rdd.getNumPartitions() <= 1:
        return local.select(F.col("a").alias("node"), F.col("b").alias("label"))
    loops = local.filter("a = b").select(F.col("a").alias("node"), F.col("a").alias("label"))
    edges, seen = local.filter("a > b").distinct(), None
    for _ in range(max_rounds):
        edges = kept(_star(_star(edges, True), False))
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("the components have not converged")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        edges.select("b", "b")).union(loops).groupBy("node").agg(F.min("label").alias("label"))
