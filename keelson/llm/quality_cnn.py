"""A byte-level convolutional quality classifier in numpy.

A document is a run of chunks of ``2 * BLOCK`` bytes, each beginning ``BLOCK`` bytes after the
one before, so chunks overlap and cover the whole text. Learned filters over ``WIDTH`` bytes move
over each chunk in steps of ``STRIDE``; their largest responses are the chunk's features. The
largest and the mean of a document's chunk features, and how much text there is, give one
probability.

The model is fitted in the driver on a bounded sample of labelled texts and broadcast; scoring
passes over the documents once, without a shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk

WIDTH, STRIDE, FILTERS, BLOCK = 8, 4, 24, 256
# The fitting sample: rows of each label, and the bytes that all of them may have together. Texts
# are in it whole, whatever their length.
SAMPLE_ROWS, SAMPLE_BYTES = 2_000, 32 << 20
TILE = 1 << 15
# A text shorter than this many bytes has had less chance to show any pattern: its share of each.
FILLS = (64, 256, 1024)


class ByteCNN:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.25, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.table[:, 0] = 0                      # padding says nothing
        self.bias = np.zeros(FILTERS, np.float32)
        self.weights = rng.normal(0, 0.1, 2 * FILTERS + len(FILLS)).astype(np.float32)
        self.offset = np.zeros(1, np.float32)

    @staticmethod
    def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts end to end, each filled up to whole blocks with room for a last window, and the
        first block of each."""
        sizes = np.diff(offsets)
        blocks = -(-(sizes + WIDTH - STRIDE) // BLOCK)
        first = np.concatenate([[0], np.cumsum(blocks)])
        out = np.zeros(first[-1] * BLOCK + WIDTH, np.uint8)
        out[np.arange(len(data)) + np.repeat(first[:-1] * BLOCK - offsets[:-1], sizes)] = data
        return out, first

    def blocks(self, text: np.ndarray, first: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """The largest response of each filter in each block (0 at least), and its place."""
        steps, n = BLOCK // STRIDE, int(first[-1])
        most = np.zeros((n, FILTERS), np.float32)
        place = np.zeros((n, FILTERS), np.int64) if where else None
        per = TILE // steps
        for low in range(0, n, per):
            high = min(n, low + per)
            sums = np.zeros(((high - low) * steps, FILTERS), np.float32)
            for j in range(WIDTH):
                sums += self.table[j].take(text[low * BLOCK + j:high * BLOCK + j:STRIDE], axis=0)
            sums = sums.reshape(high - low, steps, FILTERS)
            ends = first[1:] - 1            # the last window of a text is all padding, but reaches into the next one
            sums[ends[(ends >= low) & (ends < high)] - low, -1] = 0
            if where:
                place[low:high] = sums.argmax(1)
            np.maximum(sums.max(1) + self.bias, 0, out=most[low:high])
        return most, place

    @staticmethod
    def chunks(most: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chunk features (each block with the next one of its text), and which block won."""
        follows = np.ones(len(most), bool)
        follows[first[1:] - 1] = False
        after = np.zeros_like(most)
        after[:-1] = most[1:]
        after[~follows] = -1
        return np.maximum(most, after), after > most

    @staticmethod
    def pooled(chunk: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The largest and the mean chunk features of each text, and how full it is."""
        mean = np.add.reduceat(chunk, first[:-1]) / np.diff(first)[:, None].astype(np.float32)
        fill = np.minimum(sizes[:, None] / np.array(FILLS, np.float32), 1).astype(np.float32)
        return np.concatenate([np.maximum.reduceat(chunk, first[:-1]), mean, fill], axis=1)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One probability for each text; a text without bytes is one block of padding."""
        if len(offsets) < 2:
            return np.zeros(0)
        text, first = self.padded(data, offsets)
        chunk, _ = self.chunks(self.blocks(text, first)[0], first)
        z = (self.pooled(chunk, first, np.diff(offsets)) * self.weights).sum(1, dtype=np.float64) + self.offset[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def fit(self, texts: list[bytes], labels: list[int], epochs: int = 10, batch: int = 48, rate: float = 0.02, seed: int = 5) -> None:
        """Adam on the log loss, with both labels weighted alike. The gradient of a largest value
        goes to the place that holds it."""
        y = np.array(labels, np.float32)
        if not len(y) or y.min() == y.max():      # nothing to tell apart
            self.weights[:] = 0
            self.offset[:] = 0 if not len(y) else (3 if y[0] else -3)
            return
        share = y.mean()
        weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
        params = [self.table, self.bias, self.weights, self.offset]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        rng, step = np.random.default_rng(seed), 0
        for epoch in range(epochs):
            order = rng.permutation(len(y))
            pace = rate * (1 - epoch / epochs)
            for low in range(0, len(y), batch):
                rows, step = order[low:low + batch], step + 1
                offsets = np.concatenate([[0], np.cumsum([len(texts[r]) for r in rows])]).astype(np.int64)
                data = np.frombuffer(b"".join(texts[r] for r in rows), np.uint8)
                grads = self._gradients(*self.padded(data, offsets), np.diff(offsets), y[rows], weight[rows] / len(rows))
                for p, g, (m, v) in zip(params, grads, moments, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= pace * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
                self.table[:, 0] = 0

    def _gradients(self, text: np.ndarray, first: np.ndarray, sizes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        most, place = self.blocks(text, first, where=True)
        chunk, later = self.chunks(most, first)
        counts = np.diff(first)
        feats = self.pooled(chunk, first, sizes)
        top = feats[:, :FILTERS]
        p = 1 / (1 + np.exp(-np.clip(feats @ self.weights + self.offset[0], -30, 30)))
        dz = (p - y) * weight
        df = dz[:, None] * self.weights
        doc = np.repeat(np.arange(len(counts)), counts)
        dchunk = (df[:, FILTERS:2 * FILTERS] / counts[:, None])[doc]
        best = chunk == top[doc]
        ties = np.add.reduceat(best.astype(np.float32), first[:-1])
        dchunk += best * (df[:, :FILTERS] / ties)[doc]
        dmost = np.where(later, 0, dchunk)
        dmost[1:] += np.where(later, dchunk, 0)[:-1]
        dmost *= most > 0
        dtable = np.zeros_like(self.table)
        at = np.arange(len(most))[:, None] * BLOCK + place * STRIDE
        filters = np.broadcast_to(np.arange(FILTERS), at.shape)
        for j in range(WIDTH):
            flat = np.bincount((text[at + j].astype(np.int64) * FILTERS + filters).ravel(), dmost.ravel(), 256 * FILTERS)
            dtable[j] = flat.reshape(256, FILTERS)
        return [dtable, dmost.sum(0), (dz[:, None] * feats).sum(0), np.array([dz.sum()], np.float32)]


def held_out(doc_id: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
                rows: int = SAMPLE_ROWS, budget: int = SAMPLE_BYTES) -> ByteCNN:
    """A model of ``label`` (0 or 1) from documents that are not held out: of each label the first in
    the order of a hash of their ids, whole texts of any length, up to ``rows`` of them and until
    the next one would take the label's sample over ``budget`` bytes (one at least). Null ids, texts and
    labels are not learned from. Without labelled documents every score is one half."""
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(doc_id)) \
        .select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"))
    drawn = None
    for y in (0, 1):
        part = usable.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(rows * 4 // 3)
        drawn = part if drawn is None else drawn.union(part)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.octet_length(text).alias("size")).filter("text IS NOT NULL")
    found = texts.join(F.broadcast(drawn.groupBy("id").agg(F.max("y").alias("y"))), "id")
    sample = []
    for y in (0, 1):
        best = found.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id", "text").limit(rows)
        sizes = [r["size"] for r in best.select("size").collect()]
        n = max(1, int(np.searchsorted(np.cumsum(sizes), budget, "right"))) if sizes else 0
        sample += [(r["text"].encode(), y) for r in best.limit(n).select("text").collect()]
    model = ByteCNN()
    model.fit([t for t, _ in sample], [y for _, y in sample])
    return model


def quality_scores(docs: DataFrame, model: ByteCNN, text: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the probability ``name`` that a text is good. Only the text is
    read. Null and empty texts get the score of an empty text, equal texts equal scores. A column
    of that name is replaced. An empty table gives an empty result."""
    docs = docs.drop(name)
    at, names = docs.columns.index(text), docs.columns
    shipped = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = cloudpickle.loads(shipped.value)
        for batch in batches:
            parts = [model.scores(c.data, c.offsets) for c in tk.chunks(batch.column(at))]
            scores = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))
