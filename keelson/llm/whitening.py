"""Whitening of embeddings by a polarisation covariance.

Entries become whole numbers, and everything up to the covariance is exact. With y the values
centred by whole numbers, one pass sums the squares y_i^2 of every dimension and (y_i + y_j)^2 of every
pair of dimensions; what the centring left over is taken out exactly afterwards. Half the sum's
variance less the two variances is the covariance of the pair: no product of two different
dimensions is ever formed. The assembled matrix goes to ``eigh``."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How entries become whole numbers.
SCALE, SHIFT = 1024, 100_000
# Entries from here on have no long; a vector that holds one is left out like one that is not finite.
LARGEST = float(1 << 62)
# Vectors handled at once, and 32-bit limbs of the exact sums (signed at the top).
ROWS, LIMBS = 1024, 6
DECIMAL = 10 ** 38


def matrix(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(usable rows, their whole numbers) of an Arrow list column: rows that
    are not null and hold ``dims`` finite entries."""
    lists = column.cast(pa.list_(pa.float64()))
    sizes = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == dims)
    if not dims or not len(rows):
        return rows[:0], np.zeros((0, dims), np.int64)
    flat = lists.take(pa.array(rows)).flatten()
    gaps = flat.is_null().to_numpy(zero_copy_only=False).reshape(-1, dims)
    scaled = np.floor(SCALE * flat.fill_null(0).to_numpy(zero_copy_only=False).reshape(-1, dims))
    good = ~gaps.any(1) & (np.abs(scaled) < LARGEST).all(1)      # false for values that are not finite
    return rows[good], scaled[good].astype(np.int64) + SHIFT


def limbs(total: int) -> list[int]:
    return [total >> 32 * k & 0xFFFFFFFF for k in range(LIMBS - 1)] + [total >> 32 * (LIMBS - 1)]


def exact_sums(frame: DataFrame, values, n_values: int) -> list[int]:
    """Sums over all rows of ``frame`` of the vectors that ``values`` (batch -> iterator of lists of
    Python or numpy integers) yields. Every task sends one row a place; the sums are taken by Spark
    limb by limb and are exact at any size. ``n_values`` numbers reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * n_values
        for batch in batches:
            for part in values(batch):
                total = [a + int(b) for a, b in zip(total, part, strict=True)]
        if any(total):
            split = [limbs(x) for x in total]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(n_values), pa.int32()), *(pa.array([x[k] for x in split], pa.int64()) for k in range(LIMBS))],
                ["place", *(f"l{k}" for k in range(LIMBS))])

    parts = frame.mapInArrow(run, "place int, " + ", ".join(f"l{k} long" for k in range(LIMBS)))
    out = [0] * n_values
    for r in parts.groupBy("place").agg(*(F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS))).collect():
        out[r["place"]] = sum(r[f"l{k}"] << 32 * k for k in range(LIMBS))
    return out


def polarised(y: np.ndarray) -> list[int]:
    """Sums of the squares of every column, then of the sums of every two columns (i < j), exact."""
    dims = y.shape[1]
    i, j = np.triu_indices(dims, 1)
    if int(np.abs(y).max(initial=0)) >= 1 << 24:                  # squares could leave 64 bits
        y = y.astype(object)
    total = np.zeros(dims + len(i), y.dtype)
    for low in range(0, len(y), ROWS):
        part = y[low:low + ROWS].T
        total[:dims] += (part * part).sum(1)
        at = dims
        for d in range(dims - 1):                                 # column d with all later ones
            both = part[d + 1:] + part[d]
            total[at:at + len(both)] += (both * both).sum(1)
            at += len(both)
    return total.tolist()


@dataclass
class Whitening:
    """A fitted model: whole-number centre, what it leaves over (n mean - n centre), eigenvectors."""

    n: int = 0
    dims: int = 0
    centre: list[int] = field(default_factory=list)
    rest: list[int] = field(default_factory=list)
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    trace: float = 0.0

    def projected(self, x: np.ndarray, k: int) -> np.ndarray:
        """The first ``k`` whitened components; nan where the eigenvalue is not above rounding."""
        y = x - np.array(self.centre, np.int64)
        # n y - rest is exact; one division gives x - S / n to double precision.
        if self.n * (int(np.abs(y).max(initial=0)) + 1) < 1 << 62:
            centred = (self.n * y - np.array(self.rest, np.int64)) / self.n
        else:
            centred = ((self.n * y.astype(object) - np.array(self.rest, object)) / self.n).astype(float)
        floor = 1e-12 * max(float(self.values[0]), 0.0) if len(self.values) else 0.0
        root = np.where(self.values[:k] > floor, np.sqrt(np.maximum(self.values[:k], 0)), np.nan)
        return centred @ self.vectors[:, :k] / root

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sum over dimensions of (n x - S)^2."""
        y = x - np.array(self.centre, np.int64)
        rest = np.array(self.rest, object)
        if int(np.abs(y).max(initial=0)) >= 1 << 24 or self.n >= 1 << 32:
            y = y.astype(object)
            square, cross = (y * y).sum(1).tolist(), (y * rest).sum(1).tolist()
        else:
            square, cross = (y * y).sum(1).tolist(), (y * rest.astype(np.int64)).sum(1).tolist()
        fixed = sum(r * r for r in self.rest)
        return [self.n * self.n * s - 2 * self.n * c + fixed for s, c in zip(square, cross, strict=True)]


def dimension(vectors: DataFrame, vector: str) -> int:
    """The most frequent number of entries (of equally frequent ones the largest)."""
    best = (vectors.select(F.size(vector).alias("d")).filter(F.col("d") > 0).groupBy("d").agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), F.desc("d")).limit(1).collect())
    return best[0]["d"] if best else 0


def covariance(sums: list[int], n: int, rest: list[int]) -> list[list[Fraction]]:
    """The exact covariance (divisor ``n``) from the sums of ``polarised``. For whole-number centres
    that leave ``rest``, n^2 variance = n sum(y^2) - rest^2, and likewise of y_i + y_j."""
    dims = len(rest)
    spread = [n * s - r * r for s, r in zip(sums, rest)]
    out = [[Fraction(0)] * dims for _ in range(dims)]
    pair = iter(sums[dims:])
    for i in range(dims):
        out[i][i] = Fraction(spread[i], n * n)
        for j in range(i + 1, dims):
            both = n * next(pair) - (rest[i] + rest[j]) ** 2
            out[i][j] = out[j][i] = Fraction(both - spread[i] - spread[j], 2 * n * n)
    return out


def fit_whitening(vectors: DataFrame, vector: str = "embedding") -> Whitening:
    """A model of all usable vectors: two passes, of which dims (dims + 3) / 2 + 1 sums reach the driver.
    Vectors that are null, hold null entries, entries that are not finite or beyond a long, or have
    another number of entries than most, are left out."""
    dims = dimension(vectors, vector)
    if not dims:
        return Whitening()
    only = vectors.select(vector)

    def totals(batch: pa.RecordBatch) -> Iterator[list[int]]:
        rows, x = matrix(batch.column(0), dims)
        if int(np.abs(x).max(initial=0)) >= 1 << 44:
            x = x.astype(object)
        yield [len(rows), *x.sum(0).tolist()]

    n, *sums = exact_sums(only, totals, dims + 1)
    if not n:
        return Whitening(0, dims)
    centre = [s // n for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]

    def squares(batch: pa.RecordBatch) -> Iterator[list[int]]:
        _, x = matrix(batch.column(0), dims)
        yield polarised(x - np.array(centre, np.int64))

    exact = covariance(exact_sums(only, squares, dims * (dims + 1) // 2), n, rest)
    values, axes = np.linalg.eigh(np.array([[float(x) for x in row] for row in exact]))
    values, axes = values[::-1], axes[:, ::-1]
    axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(dims)] < 0, -1.0, 1.0)
    return Whitening(n, dims, centre, rest, values, axes, float(sum(exact[i][i] for i in range(dims))))


def identity_error(vectors: DataFrame, model: Whitening, components: int, vector: str = "embedding") -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, measured
    on all vectors; components without an eigenvalue above rounding do not count."""
    k = min(components, model.dims)
    if not model.n:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = np.nan_to_num(model.projected(matrix(batch.column(0), model.dims)[1], k))
            one, two = one + w.sum(0), two + w.T @ w
        flat = np.concatenate([one, two.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["place", "part"])

    total = np.zeros(k + k * k)
    for r in vectors.select(vector).mapInArrow(run, "place int, part double").groupBy("place").agg(F.sum("part").alias("s")).collect():
        total[r["place"]] = r["s"]
    mean, second = total[:k] / model.n, total[k:].reshape(k, k) / model.n
    real = np.diag(second) > 0
    gap = np.abs(second - np.outer(mean, mean) - np.eye(k))[np.ix_(real, real)]
    return float(gap.max(initial=0.0))


def whiten(vectors: DataFrame, components: int = 8, vector: str = "embedding", model: Whitening | None = None) -> DataFrame:
    """The columns of ``vectors`` but the vector, and for each usable vector and each of the first
    ``components`` components a row with component (from 1, by falling eigenvalue), n, deviation
    (sum of (n x - S)^2, exact), whitened, explained and identity_error.

    x is floor(1024 entry) + 100000. The deviation is a decimal of 38 digits, null beyond. Where a
    component's eigenvalue is not above rounding (constant or dependent dimensions, a single
    vector), whitened is null; explained is null where nothing varies. Repeated vectors count
    repeatedly and give equal rows. Columns of those names are replaced. Without usable vectors the
    result is empty."""
    made = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    model = model or fit_whitening(vectors, vector)
    error = identity_error(vectors, model, components, vector)
    vectors = vectors.drop(*(c for c in vectors.columns if c.lower() in made and c != vector))
    names = [c for c in vectors.columns if c != vector]
    at, k = vectors.columns.index(vector), min(components, model.dims)
    fields = [T.StructField("component", T.IntegerType()), T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.DoubleType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if model.n else ():
            rows, x = matrix(batch.column(at), model.dims)
            if not len(rows):
                continue
            take = pa.array(np.repeat(rows, k))
            far = [d if d < DECIMAL else None for d in model.deviations(x)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(take) for i in range(batch.num_columns) if i != at),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                 pa.array(far, pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(len(rows)), k))),
                 pa.array(model.projected(x, k).ravel(), from_pandas=True)],
                [*names, "component", "deviation", "whitened"])

    out = vectors.mapInArrow(run, T.StructType([*(vectors.schema[c] for c in names), *fields]))
    shares = F.array(*(F.lit(float(v) / model.trace) if model.trace > 0 else F.lit(None).cast("double") for v in model.values[:k]))
    explained = F.get(shares, F.col("component") - 1) if k else F.lit(None).cast("double")
    return out.select(*[F.col(f"`{c}`") for c in names], "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                      explained.alias("explained"), F.lit(error).alias("identity_error"))
