"""Physical layout and data skipping.

Layouts are produced with range partitioning, so a range predicate on the layout column
touches few files; compaction and z-order cut their ranges by bytes, for files of a target
size. Writes always go to a new directory; a directory is never read and overwritten by the
same job.
"""

from __future__ import annotations

import bisect
import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators.ranks import Cell, as_number, cells, doubles, with_position
from keelson.session import remove_path, scratch_path
from keelson.sources import sinks

# What a file should hold unless the caller says otherwise.
TARGET_BYTES = 128 * 1024 * 1024
# Rows a task should sort at once.
FILE_ROWS = 2_000_000
# Rounds of trial files at most: each is planned by what the one before has measured.
ROUNDS = 4


def files_for(df: DataFrame, least: int, rows: int = FILE_ROWS) -> int:
    """Files for a sorted or shuffled layout: ``least`` of them, and so many for a larger table that
    none holds more than about ``rows`` rows, since each file is one task's sort. Counts ``df``,
    which should be a table."""
    return max(least, -(-df.count() // rows))


def sorted_layout(df: DataFrame, column: str | Column, files: int) -> DataFrame:
    """Range partition into ``files`` partitions on ``column``, sorted inside."""
    c = F.col(column) if isinstance(column, str) else column
    return df.repartitionByRange(files, c).sortWithinPartitions(c)


def write_sorted(df: DataFrame, path: str, column: str, files: int) -> None:
    """Sorted layout on the filter column (L3): each file covers one key range."""
    sinks.rebuild(sorted_layout(df, column, files), path)


def write_shuffled(df: DataFrame, path: str, files: int, seed: int = 42) -> None:
    """Random layout, the control (O7): every file spans the whole key range."""
    sinks.rebuild(df.repartition(files, F.xxhash64(*[F.col(c) for c in df.columns], F.lit(seed))), path)


def write_small_batches(df: DataFrame, path: str, batches: int) -> None:
    """Many small files (L9): ``batches`` files of about equal size."""
    sinks.rebuild(df.repartition(batches), path)


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of a table's Parquet files, listed; their contents are never read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                 .option("pathGlobFilter", "*.parquet").load(path).select("path", "length"))


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes before compression: what its strings and binaries hold and the
    width of everything else."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + 4)
        elif isinstance(f.dataType, T.ArrayType):
            parts.append(F.greatest(F.size(c), F.lit(0)) * 8 + 4)
        else:
            parts.append(F.lit(8))
    total = F.lit(0)
    for x in parts:
        total = total + x
    return total.cast("double")


@dataclass(frozen=True)
class SizePlan:
    """Which file each row goes to: file ``base[g] + salt`` for the last ``start[g]`` at most its order
    number, where a single heavy value has ``files[g]`` files and any other range one."""

    start: tuple[float, ...] = (-math.inf,)
    base: tuple[int, ...] = (0,)
    files: tuple[int, ...] = (1,)

    @property
    def total(self) -> int:
        return self.base[-1] + self.files[-1]

    def with_file(self, df: DataFrame, name: str, number: str, salt: Column) -> DataFrame:
        """``df`` with each row's file as the column ``name``."""
        df = with_position(df, "__g", F.col(number), self.start[1:])
        share = F.pmod(salt, F.get(doubles(self.files), F.col("__g")).cast("long"))
        return df.withColumn(name, (F.get(doubles(self.base), F.col("__g")).cast("long") + share).cast("int")).drop("__g")


def plan_files(summary: Sequence[Cell], per_file: float) -> SizePlan:
    """Cut points that give every file about ``per_file`` of the summary's weight. Ranges are filled
    one after the other, a value that fills more than a file by itself has a range of its own, and
    what is left over beside one, below half a file, goes to the lighter neighbour."""
    total = sum(c.weight for c in summary)
    if not summary or total <= 0:
        return SizePlan()
    per_file = total / max(1, round(total / per_file))
    groups: list[list[float]] = []                                 # lowest number, weight
    filling = False
    for c in summary:
        heavy = c.low == c.high and c.weight >= 1.5 * per_file
        if filling and not heavy and groups[-1][1] + c.weight / 2 <= per_file:
            groups[-1][1] += c.weight
        else:
            groups.append([c.low, c.weight])
        filling = not heavy
    i = 0
    while len(groups) > 1 and i < len(groups):
        if groups[i][1] >= per_file / 2:
            i += 1
            continue
        to = min((j for j in (i - 1, i + 1) if 0 <= j < len(groups)), key=lambda j: groups[j][1])
        low = min(i, to)
        groups[low:low + 2] = [[groups[low][0], groups[low][1] + groups[low + 1][1]]]
        i = low
    files = [max(1, round(w / per_file)) for _, w in groups]
    return SizePlan(tuple(g[0] for g in groups), tuple(accumulate([0, *files[:-1]])), tuple(files))


def sized_layout(df: DataFrame, number: Column, target_bytes: int, pilot_dir: str, order: Sequence[str] = (),
                 pilots: int = 16) -> DataFrame:
    """``df`` dealt out so that each task writes one file of about ``target_bytes``.

    A weighted quantile summary of ``number`` (the order, as a number) says how many bytes lie where.
    How well they compress depends on the layout itself and on the place, so up to ``pilots`` ranges,
    evenly spaced and each of about a file's size, are written to ``pilot_dir`` first and measured;
    each tells for the ranges around it, and the next round is planned by that until the trial files
    have the target size. File count and cut points follow from both;
    a file over the border between ranges that compress very differently may miss the target. A value too heavy
    for one file is split by a hash of the row. Files are disjoint ranges otherwise, sorted by
    ``order`` inside."""
    spark = df.sparkSession
    # The number comes out of a generator: filters on what is made of it stay above, so it is computed
    # once a row however large its expression is.
    keyed = df.select("*", row_bytes(df).alias("__w"), F.explode(F.array(number.cast("double"))).alias("__n"))
    ordered = lambda x: x.sortWithinPartitions(*order) if order else x
    salt = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    weight = keyed.agg(F.sum("__w")).first()[0]
    if not weight:
        return df.coalesce(1)
    # The summary is fine enough for files that compress to a quarter of their bytes or better.
    raw = cells(keyed, "__n", "__w", min(0.05, target_bytes / 4 / weight))

    plan = plan_files(raw, target_bytes)
    for _ in range(ROUNDS):                                        # from the second round on, pilots are real files
        step = max(1.0, plan.total / pilots)
        chosen = sorted({min(plan.total - 1, int(step / 2 + i * step)) for i in range(pilots)})
        trial = plan.with_file(keyed, "__f", "__n", salt).filter(F.col("__f").isin(chosen))
        trial = with_position(trial, "__slot", F.col("__f"), chosen).withColumn("__slot", F.col("__slot") - 1)
        spot = f"{pilot_dir.rstrip('/')}/pilot-{uuid.uuid4().hex[:12]}"
        # The weights of the trial files are summed up while they are written: no pass of their own.
        seen = Observation()
        sums = [f(F.when(F.col("__slot") == i, v)).alias(f"{name}{i}") for i in range(len(chosen))
                for name, f, v in (("w", F.sum, F.col("__w")), ("n", F.avg, F.coalesce("__n", F.lit(raw[0].low))))]
        (ordered(trial.repartitionById(len(chosen), "__slot")).observe(seen, *sums).select(*df.columns, "__slot")
         .write.partitionBy("__slot").parquet(spot))
        slot = F.regexp_extract("path", "__slot=([0-9]+)", 1).cast("int")
        wrote = {r[0]: r[1] for r in file_sizes(spark, spot).groupBy(slot).agg(F.sum("length")).collect()}
        took = {i: (seen.get[f"w{i}"], seen.get[f"n{i}"]) for i in range(len(chosen))}
        known = sorted((place, wrote[i] / w) for i, (w, place) in took.items() if w and wrote.get(i))
        if all(target_bytes * 0.6 < wrote.get(i, 0) < target_bytes * 1.6 for i in range(len(chosen))):
            break
        plan = plan_files(_scaled(raw, known), target_bytes)
    return ordered(plan.with_file(keyed, "__f", "__n", salt).repartitionById(plan.total, "__f")).select(*df.columns)


def _scaled(summary: Sequence[Cell], known: Sequence[tuple[float, float]]) -> list[Cell]:
    """The summary in written bytes: each range times the ratio measured at the nearest place."""
    if not known:
        return list(summary)
    places = [p for p, _ in known]

    def ratio(c: Cell) -> float:
        at = c.low / 2 + c.high / 2
        i = bisect.bisect_left(places, at)
        near = [j for j in (i - 1, i) if 0 <= j < len(places)]
        return known[min(near, key=lambda j: abs(places[j] - at))][1]

    return [Cell(c.low, c.high, c.weight * ratio(c)) for c in summary]


def compact(spark: SparkSession, src: str, dst: str, files: int | None = None, order: str | None = None,
            target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Compaction (L4): many small files -> files of about ``target_bytes`` (or exactly ``files`` of
    them), as ranges of ``order``; without one, rows are dealt out by a hash. Written to a new
    directory and returned as a reader of it."""
    df = spark.read.parquet(src)
    if files:
        out = sorted_layout(df, order, files) if order else df.repartition(files)
    else:
        number = as_number(F.col(order), df.schema[order].dataType) if order else F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        out = sized_layout(df, number, target_bytes, f"{dst.rstrip('/')}-pilots", [order] if order else [])
    sinks.rebuild(out, dst)
    return spark.read.parquet(dst)


def _bucket(column: str, splits: Sequence) -> Column:
    """Index of the quantile bucket of ``column`` (0..len(splits)), as a balanced
    tree of comparisons: log2(len(splits)) comparisons per row, not len(splits)."""
    c = F.col(column)

    def node(lo: int, hi: int) -> Column:       # bucket index in [lo, hi]
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2                 # values >= splits[mid - 1] go right
        return F.when(c < F.lit(splits[mid - 1]), node(lo, mid - 1)).otherwise(node(mid, hi))

    return node(0, len(splits))


def with_zorder_key(df: DataFrame, cols: Sequence[str], name: str, bits: int = 8, rel_error: float = 0.001) -> DataFrame:
    """``df`` with the z-order (Morton) value over quantile buckets of each column.

    Each column is first mapped to one of ``2**bits`` quantile buckets (so columns of
    different ranges weigh the same), then the bucket bits are interleaved. Only
    the bucket boundaries (``2**bits - 1`` numbers per column) go through the
    driver; ``approxQuantile`` itself is a distributed sketch.
    """
    probs = [i / (2 ** bits) for i in range(1, 2 ** bits)]
    splits = df.approxQuantile(list(cols), probs, rel_error)
    names = [f"__bucket_{i}" for i in range(len(cols))]
    for n, c, s in zip(names, cols, splits):
        df = with_position(df, n, F.col(c).cast("double"), sorted(set(s)))
    df = df.withColumns({n: F.col(n).cast("bigint") for n in names})
    z = F.lit(0).cast("bigint")
    for b in range(bits):
        for i, n in enumerate(names):
            bit = F.shiftright(F.col(n), b).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit, b * len(cols) + i))
    return df.withColumn(name, z).drop(*names)


def zorder(df: DataFrame, cols: Sequence[str], files: int | None = None, bits: int = 8,
           target_bytes: int = TARGET_BYTES, pilot_dir: str | None = None) -> DataFrame:
    """Z-ordered layout (L5): ranges of the Morton value, sorted inside, in files of about
    ``target_bytes`` (``pilot_dir`` takes the trial files) or in ``files`` partitions; a filter on any
    one of ``cols`` then touches a fraction of the files."""
    keyed = with_zorder_key(df, cols, "__z", bits)
    if files:
        return keyed.repartitionByRange(files, "__z").sortWithinPartitions("__z").drop("__z")
    return sized_layout(keyed, F.col("__z"), target_bytes, pilot_dir or scratch_path(df.sparkSession, "zorder-pilots"), ["__z"]).drop("__z")


def layout_summary(spark: SparkSession, path: str) -> DataFrame:
    """File census of a table directory (L6): files, total MB, MB per file."""
    return file_sizes(spark, path).agg(F.count(F.lit(1)).alias("files"),
                                       F.round(F.sum("length") / 1e6, 3).alias("total_mb"),
                                       F.round(F.sum("length") / 1e6 / F.count(F.lit(1)), 3).alias("mb_per_file"))


def size_report(spark: SparkSession, path: str, target_bytes: int) -> DataFrame:
    """One row: rows, files, bytes, smallest and largest file, and whether every file has at most twice
    and, but for one of a table below that, at least half the target (L4, L5, L6)."""
    sizes = file_sizes(spark, path).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
                                        F.min("length").alias("smallest"), F.max("length").alias("largest")).first()   # four numbers
    fits = not sizes["files"] or (sizes["largest"] <= 2 * target_bytes and (sizes["smallest"] * 2 >= target_bytes or sizes["files"] == 1))
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
    return rows.select("rows", *[F.lit(sizes[c]).cast("long").alias(c) for c in ("files", "bytes", "smallest", "largest")],
                       F.lit(fits).alias("fits"))


# The formats compared by the footprint report, CSV first (the base).
FOOTPRINT_FORMATS = [("csv", "csv", None), ("json", "json", None), ("parquet_none", "parquet", "none"),
                     ("parquet_snappy", "parquet", "snappy"), ("parquet_zstd", "parquet", "zstd")]


def format_footprint(spark: SparkSession, df: DataFrame, directory: str, keep: bool = True) -> DataFrame:
    """Same rows written as CSV, NDJSON and Parquet none/snappy/zstd (L7, K6, K7):
    (format, bytes, ratio_to_csv). The bytes are those of the written files, counted as soon as a
    format is written; without ``keep`` its files are removed then, so that there is never more than
    one format on disk."""
    counted = []
    for name, fmt, codec in FOOTPRINT_FORMATS:
        p = f"{directory.rstrip('/')}/{name}"
        sinks.write_as(df, p, fmt, codec)
        counted.append((name, spark.read.format("binaryFile").option("recursiveFileLookup", True).load(p)
                        .filter(~F.col("path").rlike(r"/(_|\.)[^/]*$"))
                        .agg(F.sum("length")).first()[0]))         # one scalar
        if not keep:
            remove_path(spark, p)
    csv_bytes = dict(counted)["csv"]
    return (spark.createDataFrame(counted, "format string, bytes long")
            .select("format", "bytes", F.round(F.lit(csv_bytes) / F.col("bytes"), 2).alias("ratio_to_csv")))
