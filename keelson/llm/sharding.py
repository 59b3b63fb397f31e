"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``cells`` equal arcs. Every shard owns ``virtual_nodes`` points on it, and a cell
belongs to the next point clockwise. A key asks the owner of its cell; when that shard is full
it goes on clockwise to the next point of another shard with room. The capacities add up to
the number of rows and differ by at most one, so the counts do too.

The walk needs the number of keys in each cell, not the keys: Spark counts the cells, the
driver places those ``cells`` numbers (their count is a parameter, whatever the corpus), and
the resulting ranges of ranks are joined back. DataFrame functions only."""

from __future__ import annotations

import bisect
import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import utf8, whole


@dataclass(frozen=True)
class Ring:
    shards: int = 24
    virtual_nodes: int = 64
    cells: int = 4096          # a power of two up to 65536

    def points(self) -> list[tuple[int, int]]:
        """(cell, shard) of every virtual node, clockwise."""
        at = lambda s, v: int(hashlib.md5(f"{s}:{v}".encode()).hexdigest()[:4], 16) * self.cells >> 16
        return sorted((at(s, v), s) for s in range(self.shards) for v in range(self.virtual_nodes))

    def cell_of(self, key: Column) -> Column:
        """The first 16 bits of the key's MD5, scaled to the cells. A null key is the key ''."""
        digest = F.substring(F.md5(utf8(F.coalesce(key.cast("string"), F.lit("")))), 1, 4)
        return F.shiftright(F.conv(digest, 16, 10).cast("int") * self.cells, 16)

    def place(self, counts: dict[int, int]) -> list[tuple[int, int, int, int, int]]:
        """(cell, low, high, shard, first slot): ranks low to high - 1 of the cell go there.

        In rounds: all cells ask their first shard, in ring order, before any overflow asks its
        second one; so a key moves only if its own shard is full of keys that hash to it."""
        total, points = sum(counts.values()), self.points()
        room = [total // self.shards + (s < total % self.shards) for s in range(self.shards)]
        filled, placed = [0] * self.shards, []
        cells = [c for c, _ in points]
        waiting = [(c, 0, n, bisect.bisect_left(cells, c)) for c, n in sorted(counts.items()) if n]
        while waiting:
            later = []
            for cell, low, high, p in waiting:
                shard = points[p % len(points)][1]
                n = min(high - low, room[shard] - filled[shard])
                if n:
                    placed.append((cell, low, low + n, shard, filled[shard]))
                    filled[shard] += n
                if low + n < high:
                    while filled[points[p % len(points)][1]] == room[points[p % len(points)][1]]:
                        p += 1
                    later.append((cell, low + n, high, p))
            waiting = later
        return placed


def shard_rows(rows: DataFrame, key: str, order: list[str], ring: Ring = Ring()) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (gapless from 0 in each shard).

    ``rows`` should be slim (keys and sizes, not texts): they are sorted by cell. Within a cell
    rows rank by ``order``; rows equal in all of it are interchangeable. A cell holds about one
    in ``cells`` of the distinct rows; rows equal in all columns are counted before the sort
    and laid out again afterwards, so a row repeated a billion times does not fill one task.
    A null key is a key like any other. An empty table gives an empty result."""
    spark = rows.sparkSession
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("__n")).withColumn(
        "__cell", ring.cell_of(F.col(key)))
    counts = {r[0]: r[1] for r in counted.groupBy("__cell").agg(F.sum("__n")).collect()}
    plan = spark.createDataFrame(ring.place(counts), "cell int, low long, high long, shard int, first long")
    w = Window.partitionBy("__cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumn("__low", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    # Repeats meet the plan as ranges of ranks; each overlap is then laid out in blocks of rows.
    low, high = F.greatest("__low", "low"), F.least(F.col("__low") + F.col("__n"), F.col("high"))
    met = (ranked.join(F.broadcast(plan), (F.col("__cell") == F.col("cell")) & (F.col("__low") < F.col("high"))
                       & (F.col("__low") + F.col("__n") > F.col("low")))
           .withColumn("__from", low).withColumn("__to", high))
    block = 1 << 16
    starts = F.explode(F.sequence(F.col("__from"), F.col("__to") - 1, F.lit(block)))
    blocks = met.withColumn("__start", starts)
    ranks = F.sequence(F.col("__start"), F.least(F.col("__start") + block, F.col("__to")) - 1)
    return (blocks.withColumn("__rank", F.explode(ranks))
            .select(*rows.columns, "shard", (F.col("first") + F.col("__rank") - F.col("low")).alias("slot")))


def shard_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ring: Ring = Ring()) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): size is the text's UTF-8 bytes plus 8, a null
    text has none and the checksum of no bytes. Texts themselves are not shuffled."""
    body = utf8(whole(text))
    slim = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body) + F.lit(8)).cast("long").alias("size"),
                       F.crc32(body).alias("text_crc32"))
    return shard_rows(slim, "doc_id", ["doc_id", "size", "text_crc32"], ring)
