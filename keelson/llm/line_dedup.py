"""Line deduplication on levelled sorted runs of line hashes.

A run is a Parquet table of (h1, h2, n_docs, top): a line's 128-bit hash, the number of
documents that hold it and the largest doc_id among them, dealt out and sorted by hash.
Each batch adds one run at level 0; when a level has ``fanout`` runs they are merged into one
run of the next level, so a key is rewritten once per level. The rule needs counts over all
documents and keeps the last one, so the query joins once with the merged runs; ``novel``, the
anti-join of a batch with the earlier runs, is for keep-first use only. Lines are compared with the runs
by sort-merge joins on the hash. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .columns import ascii_lower, let, strip, whole
from .tables import fresh, written

KEY = ["h1", "h2"]
# Stands for a null doc_id: below every other.
NO_ID = -(1 << 63)


def _same_rows(doc_id: str, text: str) -> Column:
    """Tells rows without a doc_id apart by their text (0 where there is an id): nothing that is
    gathered by document gathers the rows of all of them."""
    return F.when(F.col(doc_id).isNull(), F.xxhash64(whole(text))).otherwise(F.lit(0).cast("long"))


def line_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 20) -> DataFrame:
    """(doc_id, own, place, first, h1, h2): every line of ``min_chars`` code points or more by its key, its
    number in the text, and whether it is the first of its key there. Keys are lines stripped of ASCII
    white space with A-Z lower-cased. Equal keys of a text meet by sorting, so the cost of a text of n
    lines is n log n."""
    long = F.filter(F.transform(F.split(ascii_lower(whole(text)), "\n", -1), lambda x, i: F.struct(strip(x).alias("x"), i.alias("i"))),
                    lambda x: F.char_length(x["x"]) >= min_chars)
    keys = F.sort_array(F.transform(long, lambda x: F.struct(
        F.xxhash64(x["x"]).alias("h1"), F.xxhash64(F.lit(1), x["x"]).alias("h2"), x["i"].alias("place"))))
    # The hashes as arrays of their own: a field of an array's element would be taken from all of them.
    part = lambda s, name: F.transform(s, lambda x: x[name])
    same = lambda h, x, i: F.coalesce(F.get(h, i - 1) == x, F.lit(False))
    told = let(keys, lambda s: let(part(s, "h1"), lambda one: let(part(s, "h2"), lambda two: F.transform(s, lambda x, i: F.struct(
        x["place"].alias("place"), (~(same(one, x["h1"], i) & same(two, x["h2"], i))).alias("first"),
        x["h1"].alias("h1"), x["h2"].alias("h2"))))))
    # Told apart before the lines are dealt out, or each line would carry the text along.
    held = docs.select(F.coalesce(F.col(doc_id), F.lit(NO_ID)).alias("doc_id"), _same_rows(doc_id, text).alias("own"), told.alias("keys"))
    return held.select("doc_id", "own", F.explode("keys").alias("key")).select("doc_id", "own", "key.*")


@dataclass
class LineRuns:
    """The runs written so far, by level. Only their paths live in the driver."""

    spark: SparkSession
    fanout: int = 4
    levels: list[list[str]] = field(default_factory=list)

    def add(self, keys: DataFrame) -> None:
        """Add one batch of ``line_keys`` as a run, then compact the levels that are full."""
        run = keys.filter("first").groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("top"))
        self._put(run, 0)

    def _put(self, run: DataFrame, level: int) -> None:
        path = scratch_path(self.spark, f"line-run-{level}")
        run.sortWithinPartitions(*KEY).write.parquet(path)  # the aggregate has dealt it out by hash
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(self._merge(full), level + 1)

    def _merge(self, paths: list[str]) -> DataFrame:
        return (self.spark.read.parquet(*paths).groupBy(*KEY)
                .agg(F.sum("n_docs").alias("n_docs"), F.max("top").alias("top")))

    def merged(self) -> DataFrame | None:
        """One row per key over all runs; None before the first batch."""
        paths = [p for level in self.levels for p in level]
        return self._merge(paths) if paths else None

    def novel(self, keys: DataFrame) -> DataFrame:
        """The keys of a batch that no run holds (anti-join with the runs): keep-first use over
        a stream of batches is ``novel(batch)`` and then ``add(batch)``."""
        runs = self.merged()
        keys = keys.filter("first")
        return keys if runs is None else keys.join(runs.hint("merge"), KEY, "left_anti")


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 20,
                   min_docs: int = 3, batches: int = 4, fanout: int = 4) -> DataFrame:
    """(doc_id, own, dropped): for each document that loses lines, the numbers of those lines.

    The keys are written once, in ``batches`` parts by doc_id hash; each part becomes a run.
    Afterwards the merged runs name the keys found in ``min_docs`` documents, and a document
    loses a key unless it is the largest doc_id that holds it. A key that a third of all
    documents share is one row per map task before the shuffle; in the join back, adaptive
    execution splits its partition, which it can because both sides are plain tables."""
    spark = docs.sparkSession
    path = scratch_path(spark, "line-keys")
    (line_keys(docs, doc_id, text, min_chars)
     .withColumn("batch", F.pmod(F.xxhash64("doc_id", "own"), F.lit(batches)).cast("int"))
     .write.partitionBy("batch").parquet(path))
    keys = spark.read.schema("doc_id long, own long, place int, first boolean, h1 long, h2 long, batch int").parquet(path)
    runs = LineRuns(spark, fanout)
    for b in range(batches):
        runs.add(keys.filter(F.col("batch") == b).drop("batch"))
    doomed = written(runs.merged().filter(F.col("n_docs") >= min_docs).select(*KEY, "top"), "line-doomed")
    return (keys.join(doomed.hint("merge"), KEY).filter(F.col("doc_id") < F.col("top"))
            .groupBy("doc_id", "own").agg(F.collect_set("place").alias("dropped")))


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 20,
                        name: str = "lines", **options) -> DataFrame:
    """All columns of ``docs`` and the struct ``name``: n_lines, n_dropped, kept (the text that
    stays, lines joined by a newline).

    A null or empty text is one empty line, kept as an empty text. A null doc_id ranks below
    every other. Each row counts as a document of its own, so repeated rows count repeatedly,
    and all rows with the largest doc_id keep the line. A column of that name is replaced. An
    empty table gives an empty result."""
    docs = docs.drop(name)
    holder, twin, dropped, left = (fresh(docs, x) for x in ("holder", "twin", "dropped", "left"))
    drops = repeated_lines(docs, doc_id, text, min_chars, **options).select(
        F.col("doc_id").alias(holder), F.col("own").alias(twin), F.col("dropped").alias(dropped))
    lines = F.split(whole(text), "\n", -1)
    kept = let(lines, lambda ls: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col(dropped)), lambda i: F.get(ls, i)))
    stays = F.when(F.col(dropped).isNull(), lines).otherwise(kept)
    report = F.struct(F.size(lines).cast("long").alias("n_lines"),
                      (F.size(lines) - F.size(F.col(left))).cast("long").alias("n_dropped"),
                      F.array_join(left, "\n").alias("kept"))
    same = (F.coalesce(docs[doc_id], F.lit(NO_ID)) == F.col(holder)) & (_same_rows(doc_id, text) == F.col(twin))
    return docs.join(drops, same, "left").withColumn(left, stays).withColumn(name, report).drop(holder, twin, dropped, left)


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with its columns, repeated lines removed from the text (null stays null)."""
    name = fresh(docs, "lines")
    columns = [F.when(F.col(f"`{c}`").isNotNull(), F.col(name)["kept"]).alias(c) if c == text
               else F.col(f"`{c}`") for c in docs.columns]
    return drop_repeated_lines(docs, doc_id, text, name=name, **options).select(*columns)
