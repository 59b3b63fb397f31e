"""Ranks and cut points by histogram refinement: order statistics without a sort.

One pass counts the rows of up to ``BUCKETS`` ranges of an order column, with the least and
largest value of each; the range that holds the wanted rank is then cut again, with a filter on the
bare column that reaches the scan. A range of one value goes on with the next order column. Only one
number a range ever reaches the driver, nothing is shuffled but partial counts, and every count is
exact, so the ranks are, too.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1024
# Rows that may be left for the last, local sort.
ENOUGH = 50_000
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)


def as_number(c: Column, kind: T.DataType, skip: int = 0) -> Column:
    """A number in the order of ``c`` (equal numbers may stand for different values): whole numbers
    for all types but floating ones and decimals. Of strings, six bytes from byte ``skip`` on."""
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), skip + 1, 6)), 12, "0"), 16, 10).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast(kind), c)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, _WHOLE):
        return c.cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return c.cast("double")
    raise TypeError(f"no histogram over {kind.simpleString()}")


def constant(v, kind: T.DataType) -> Column:
    """``v`` as a literal of its column's type (a plain literal of a datetime would be an instant)."""
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(str(v)).cast(kind)
    return F.lit(v).cast(kind)


def compared(c: Column, kind: T.DataType, how: str, v) -> Column:
    """``c`` ``how`` ``v``, with NaN the largest number. NaN is asked for by name: the least and
    largest value that caches and files keep of a block do not tell whether it holds any."""
    if not isinstance(kind, (T.FloatType, T.DoubleType)):
        return getattr(c, {"==": "__eq__", "<": "__lt__", "<=": "__le__", ">": "__gt__", ">=": "__ge__"}[how])(constant(v, kind))
    nan, one = F.isnan(c), constant(v, kind)
    if math.isnan(v):
        return {"==": nan, "<": ~nan & c.isNotNull(), "<=": c.isNotNull(), ">": F.lit(False), ">=": nan}[how]
    return {"==": c == one, "<": (c < one) & ~nan, "<=": (c <= one) & ~nan, ">": (c > one) | nan, ">=": (c >= one) | nan}[how]


def _shared(low: str, high: str) -> int:
    """How many bytes two strings have in common at their start."""
    a, b = low.encode(), high.encode()
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def position(c: Column, kind: T.DataType, low, high, buckets: int = BUCKETS) -> Column:
    """The range of ``c`` among ``buckets`` from ``low`` to ``high``: a whole number that never falls
    as ``c`` grows. Floating infinities and NaN have ranges of their own."""
    skip = _shared(low, high) if isinstance(kind, T.StringType) else 0
    number = lambda v: as_number(v, kind, skip)
    x, a, b = number(c), number(constant(low, kind)), number(constant(high, kind))
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        share = (x / 2 - a / 2) / F.greatest(b / 2 - a / 2, F.lit(5e-324))
        inner = 1 + F.least(F.floor(share * (buckets - 4)), F.lit(buckets - 4))
        return (F.when(F.isnan(x), buckets - 1).when(x == math.inf, buckets - 2)
                .when(x == -math.inf, 0).otherwise(inner)).cast("int")
    half = lambda v: F.shiftright(v, 1).cast("double")  # noqa: E731  no overflow over the whole range of longs
    if isinstance(kind, _WHOLE) and int(high) - int(low) >= 1 << 62:
        share = (half(x) - half(a)) / (half(b) - half(a) + 1)
    else:
        share = (x - a).cast("double") / ((b - a).cast("double") + 1)
    return F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("int")


@dataclass(frozen=True)
class Region:
    """The rows that equal ``fixed`` in the first order columns and lie from ``low`` to ``high`` in the
    next one; ``open`` before that column has been looked at. ``before`` rows are ordered earlier."""

    fixed: tuple = ()
    low: object = None
    high: object = None
    before: int = 0
    rows: int = -1
    open: bool = True
    finite: tuple = ()

    def inside(self, order: Sequence[tuple[Column, T.DataType]]) -> Column:
        cond = F.lit(True)
        for (c, kind), v in zip(order, self.fixed):
            cond = cond & (c.isNull() if v is None else compared(c, kind, "==", v))
        if not self.open:
            c, kind = order[len(self.fixed)]
            cond = cond & compared(c, kind, ">=", self.low) & compared(c, kind, "<=", self.high)
        return cond

    def _beyond(self, order: Sequence[tuple[Column, T.DataType]], last: bool) -> Column:
        """Rows from the region's start on (``last``: up to its end), nulls first."""
        cond = None
        if not self.open:
            c, kind = order[len(self.fixed)]
            cond = (c.isNull() | compared(c, kind, "<=", self.high)) if last else compared(c, kind, ">=", self.low)
        for (c, kind), v in reversed(list(zip(order, self.fixed))):
            if v is None:
                there = F.lit(True) if cond is None else cond
                cond = (c.isNull() & there) if last else (c.isNotNull() | there)
            elif cond is None:
                cond = (c.isNull() | compared(c, kind, "<=", v)) if last else compared(c, kind, ">=", v)
            else:
                side = (c.isNull() | compared(c, kind, "<", v)) if last else compared(c, kind, ">", v)
                cond = side | (compared(c, kind, "==", v) & cond)
        return F.lit(True) if cond is None else cond

    def onwards(self, order: Sequence[tuple[Column, T.DataType]]) -> Column:
        return self._beyond(order, last=False)

    def upto(self, order: Sequence[tuple[Column, T.DataType]]) -> Column:
        return self._beyond(order, last=True)


def typed(df: DataFrame, order: Sequence[str]) -> list[tuple[Column, T.DataType]]:
    return [(F.col(c), df.schema[c].dataType) for c in order]


def locate(df: DataFrame, order: Sequence[str], ranks: Sequence[int], enough: int = ENOUGH) -> list[Region]:
    """For each 1-based rank in ``order`` (ascending, nulls first) a region of at most ``enough`` rows
    that holds it; larger only where more rows than that agree in all order columns, or differ by
    less than the histogram can tell. A rank beyond the last row gives a region of no rows.

    All ranks share each pass; a pass divides a region by some ``BUCKETS``, so a trillion rows with
    a unique order take four passes over the order columns."""
    cols = typed(df, order)
    df = df.select(*order)
    state = {r: Region() for r in ranks}
    done: set[int] = set()

    def finished(g: Region) -> bool:
        return 0 <= g.rows <= enough or len(g.fixed) == len(order)

    while len(done) < len(state):
        active = sorted({g for r, g in state.items() if r not in done}, key=lambda g: g.before)
        opened = [g for g in active if g.open]
        if opened:
            seen = _looked_at(df, cols, opened)
        for r, g in state.items():
            if r in done or not g.open:
                continue
            total, nulls, low, high, finite = seen[g]
            if r > g.before + total:                              # beyond the table
                state[r] = Region(g.fixed, g.low, g.high, g.before, 0, True)
                done.add(r)
            elif r <= g.before + nulls:
                state[r] = Region((*g.fixed, None), None, None, g.before, nulls)
            else:
                state[r] = _ranged(g.fixed, low, high, g.before + nulls, total - nulls, finite)
        done |= {r for r, g in state.items() if finished(g)}
        todo = list({g for r, g in state.items() if r not in done and not g.open})
        if not todo:
            continue
        ranges = _counted(df, cols, todo)
        for r, g in state.items():
            if r in done or g.open:
                continue
            before, cells = g.before, ranges[g]
            for rows, low, high in cells:
                if r <= before + rows:
                    break
                before += rows
            if len(cells) == 1 and low != high:                   # cannot be told apart any further
                done.add(r)
                continue
            state[r] = _ranged(g.fixed, low, high, before, rows, ())
        done |= {r for r, g in state.items() if finished(g)}
    return [state[r] for r in ranks]


def _ranged(fixed: tuple, low, high, before: int, rows: int, finite: tuple) -> Region:
    """A region of one column's range; one value moves on to the next column."""
    if low == high or (low != low and high != high):
        return Region((*fixed, low), None, None, before, rows)
    return Region(fixed, low, high, before, rows, False, finite)


def _looked_at(df, cols, regions) -> dict[Region, tuple]:
    """(rows, nulls, least, largest, (least, largest) finite value) of each region's next column."""
    aggs = []
    for i, g in enumerate(regions):
        c, kind = cols[len(g.fixed)]
        here = g.inside(cols)
        aggs += [F.count_if(here).alias(f"n{i}"), F.count_if(here & c.isNull()).alias(f"z{i}"),
                 F.min(F.when(here, c)).alias(f"a{i}"), F.max(F.when(here, c)).alias(f"b{i}")]
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            real = here & ~F.isnan(c) & (F.abs(c) < math.inf)
            aggs += [F.min(F.when(real, c)).alias(f"c{i}"), F.max(F.when(real, c)).alias(f"d{i}")]
    row = df.agg(*aggs).first().asDict()
    return {g: (row[f"n{i}"], row[f"z{i}"], row[f"a{i}"], row[f"b{i}"], (row.get(f"c{i}"), row.get(f"d{i}")))
            for i, g in enumerate(regions)}


def _counted(df, cols, regions) -> dict[Region, list[tuple]]:
    """(rows, least, largest) of the non-empty ranges of each region, in order: one pass for all."""
    cells = []
    for i, g in enumerate(regions):
        at = len(g.fixed)
        low, high = g.low, g.high
        if g.finite and g.finite[0] is not None:
            low, high = g.finite
        cells.append(F.when(g.inside(cols), F.struct(
            F.lit(i).alias("g"), position(*cols[at], low, high).alias("cell"))))
    used = sorted({len(g.fixed) for g in regions})
    spread = df.select(*[cols[k][0].alias(f"v{k}") for k in used], F.explode(F.array_compact(F.array(*cells))).alias("x"))
    counted = spread.groupBy("x.g", "x.cell").agg(
        F.count(F.lit(1)).alias("n"), *[f(f"v{k}").alias(f"{name}{k}") for k in used for name, f in (("a", F.min), ("b", F.max))])
    out: dict[Region, list[tuple]] = {g: [] for g in regions}
    for r in sorted(counted.collect(), key=lambda r: (r["g"], r["cell"])):
        k = len(regions[r["g"]].fixed)
        out[regions[r["g"]]].append((r["n"], r[f"a{k}"], r[f"b{k}"]))
    return out


# ---- cut points by weight -------------------------------------------------------------------


def doubles(values: Sequence[float]) -> Column:
    """A constant array: one literal in the plan, folded once, however many values it has."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def search(c: Column, splits: Sequence[float]) -> Column:
    """How many of the sorted ``splits`` are at most ``c``: a binary search in a literal array,
    log2(len(splits)) steps a row whatever the number of splits."""
    n = len(splits)
    if not n:
        return F.lit(0)
    step = [1 << k for k in range(n.bit_length() - 1, -1, -1)]
    table = doubles(splits)
    at = lambda i: F.get(table, i - 1)
    return F.aggregate(F.array(*[F.lit(s) for s in step]), F.lit(0),
                       lambda acc, s: F.when(F.coalesce(at(acc + s) <= c, F.lit(False)), acc + s).otherwise(acc))


def with_position(df: DataFrame, name: str, c: Column, splits: Sequence[float]) -> DataFrame:
    """``df`` with ``search(c, splits)`` as the column ``name``, by compiled binary search (Spark's
    Bucketizer): passes over a large table spend no interpreted steps on a row. Nulls come before
    all splits, NaN after them. Splits that repeat or are not finite are left to ``search``."""
    splits = [float(s) for s in splits]
    if not splits or not all(map(math.isfinite, splits)) or any(a >= b for a, b in zip(splits, splits[1:])):
        return df.withColumn(name, search(c, splits))
    value, at = f"{name}_value", f"{name}_at"
    step = Bucketizer(splits=[-math.inf, *splits, math.inf], inputCol=value, outputCol=at, handleInvalid="keep")
    found = step.transform(df.withColumn(value, F.coalesce(c.cast("double"), F.lit(-math.inf))))
    return found.withColumn(name, F.least(F.col(at), F.lit(float(len(splits)))).cast("int")).drop(value, at)


@dataclass(frozen=True)
class Cell:
    """A range of the order number with its weight."""

    low: float
    high: float
    weight: float


def cells(df: DataFrame, number: str, weight: str, share: float, rounds: int = 3, most: int = 1 << 20) -> list[Cell]:
    """A weighted quantile summary of the numeric column ``number``: disjoint ranges in order with
    their summed ``weight``, each at most ``share`` of the whole unless it is a single value (or
    ``rounds`` passes could not part it). Null numbers count as the smallest. At most ``most`` ranges
    reach the driver; every sum is exact."""
    buckets = min(most, max(BUCKETS, math.ceil(2 / share)))
    first = df.agg(F.min(number).alias("a"), F.max(number).alias("b"), F.sum(weight).alias("w"),
                   F.sum(F.when(F.col(number).isNull(), F.col(weight))).alias("z")).first()
    total = float(first["w"] or 0)
    out = [Cell(-math.inf, -math.inf, float(first["z"]))] if first["z"] else []
    if first["a"] is None:
        return out
    wide = [Cell(float(first["a"]), float(first["b"]), total)]
    for _ in range(rounds):
        heavy = sorted((c for c in wide if c.low < c.high and c.weight > share * total), key=lambda c: c.low)
        if not heavy:
            break
        kept = [c for c in wide if c not in heavy]
        each = max(2, buckets // len(heavy))
        x = F.col(number).cast("double")
        lows, highs = doubles([c.low for c in heavy]), doubles([c.high for c in heavy])
        got = with_position(df.select(x.alias("x"), F.col(weight).alias("w")), "g", F.col("x"), [c.low for c in heavy])
        got = got.withColumn("g", F.col("g") - 1).filter(F.col("g") >= 0)
        low, high = F.get(lows, F.col("g")), F.get(highs, F.col("g"))
        cell = F.least(F.floor((F.col("x") / 2 - low / 2) / (high / 2 - low / 2) * each), F.lit(each - 1))
        rows = (got.filter(F.col("x") <= high).groupBy("g", cell.alias("cell"))
                .agg(F.min("x").alias("a"), F.max("x").alias("b"), F.sum("w").alias("w")).collect())
        wide = kept + [Cell(r["a"], r["b"], float(r["w"])) for r in rows]
    return out + sorted(wide, key=lambda c: c.low)
