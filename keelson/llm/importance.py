"""Importance resampling of documents towards a target distribution.

Features are runs of one to ``max_n`` consecutive words, hashed into buckets. The log ratio of a
bucket's share in the target to its share in the corpus is its gain; a document's weight is the
mean gain of its features, and a draw without replacement adds Gumbel noise made from the id.

Texts are read by batch concatenation: the texts of a batch are joined with a separator that is
in no word, one pass of a regular expression finds all words, the document of each word is a
``searchsorted`` among the texts' offsets, and runs whose first and last word lie in different
documents are masked before anything is counted."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordered import sequential_id
from . import textkit as tk
from .tables import fresh, written

# The bytes of words once A-Z are lower-cased, and a byte that is in no word.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR = b"\x00"
# Words looked at together: bounds the memory that one very long text takes.
BLOCK_WORDS = 1 << 17


@dataclass(frozen=True)
class Features:
    """Runs of 1 to ``max_n`` words, in ``buckets`` buckets."""

    max_n: int = 1
    buckets: int = 10_000

    def of(self, chunk: tk.Chunk) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, row, bucket) of the runs of ``n`` words in a chunk, a block of words at a time. The
        last words of a block start the next one, where only runs that end in new words count."""
        texts = [chunk.text(r) for r in range(chunk.high - chunk.low)]
        joined = SEPARATOR.join(texts).translate(bytes(tk.LOWER))
        offsets = chunk.offsets[:-1] + np.arange(len(texts))
        inside = np.concatenate([[False], tk.ALNUM[np.frombuffer(joined, np.uint8)]])
        starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        row = np.searchsorted(offsets, starts, "right") - 1
        for low in range(0, len(starts), BLOCK_WORDS):
            high = min(low + BLOCK_WORDS, len(starts))
            begin = max(0, low - self.max_n + 1)                   # words of the block before, for runs that end here
            words = WORD.findall(joined, starts[begin], starts[high] if high < len(starts) else len(joined))
            own = row[begin:high]
            for n in range(1, min(self.max_n, len(words)) + 1):
                whole = own[:len(own) - n + 1] == own[n - 1:]
                whole[:max(0, low - begin - n + 1)] = False
                at = np.flatnonzero(whole)
                grams = words[low - begin:] if n == 1 else [b" ".join(words[i:i + n]) for i in at.tolist()]
                yield n, own[at], np.fromiter(map(crc32, grams), np.int64, len(at)) % self.buckets


def bucket_counts(docs: DataFrame, text: str = "text", features: Features = Features()) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket. Each task counts its own
    texts first, so at most ``buckets`` rows a task are shuffled. Null and empty texts have none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(features.buckets, np.int64)
        for batch in batches:
            for chunk in tk.chunks(batch.column(0)):
                for _, _, bucket in features.of(chunk):
                    total += np.bincount(bucket, minlength=features.buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["bucket", "n"])

    return docs.select(text).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """Of each bucket: floor(1000 ln(target share / corpus share)), both with one more in every
    bucket. Takes the two counts by bucket, at most ``buckets`` numbers each."""
    s_all, t_all = sum(corpus.values()), sum(target.values())
    return np.array([math.floor(1000 * math.log(float(target.get(b, 0) + 1) * float(s_all + buckets)
                                                / (float(corpus.get(b, 0) + 1) * float(t_all + buckets))))
                     for b in range(buckets)], np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the hash of the seed and the id (null: no digits)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(F.encode(key, "UTF-8"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / float(1 << 32))))


def importance_scores(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      features: Features = Features(), seed: int = 2024, target_text: str = "text",
                      name: str = "importance") -> DataFrame:
    """All columns of ``docs`` and the struct ``name``: n_words, n_features, weight, score (long).

    Words are runs of ASCII letters, digits and all non-ASCII characters, A-Z lower-cased. Null and
    empty texts have no features and weight 0. Each row is scored by itself and counts in the
    corpus, so repeated rows get equal scores. A column of that name is replaced. Empty tables
    count nothing: an empty target or corpus makes every share a uniform one, and no documents
    give an empty result. Two passes over the texts; nothing but the counts (one number a bucket)
    reaches the driver."""
    docs = docs.drop(name)
    counts = [{r["bucket"]: r["n"] for r in bucket_counts(frame, column, features).collect()}
              for frame, column in ((docs, text), (target, target_text))]
    gain = gains(*counts, features.buckets)
    at, names = docs.columns.index(text), docs.columns
    report = T.StructType([T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, found, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for chunk in tk.chunks(batch.column(at)):
                rows = chunk.high - chunk.low
                for n, row, bucket in features.of(chunk):
                    size = np.bincount(row, minlength=rows)
                    found[chunk.low:chunk.high] += size
                    # Sums of whole numbers below 2^53: exact in doubles.
                    total[chunk.low:chunk.high] += np.bincount(row, gain[bucket], rows).astype(np.int64)
                    if n == 1:
                        words[chunk.low:chunk.high] += size
            weight = np.where(found, total // np.maximum(found, 1), 0)
            parts = pa.StructArray.from_arrays([pa.array(x) for x in (words, found, weight)], ["n_words", "n_features", "weight"])
            yield pa.RecordBatch.from_arrays([*batch.columns, parts], [*names, name])

    scored = docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, report)]))
    return scored.withColumn(name, F.col(name).withField("score", F.col(name)["weight"] + noise(F.col(f"`{doc_id}`"), seed)))


def with_ranks(scored: DataFrame, doc_id: str = "doc_id", percent: int = 10, min_words: int = 20,
               name: str = "importance", rank: str = "rank") -> DataFrame:
    """``scored`` with ``rank``: of the N rows with at least ``min_words`` words, the floor(percent N /
    100) highest scores are 1, 2, 3 ...; ties go to the smaller id (null first), equal ids in any
    order; null for rows not drawn. A column of that name is replaced.

    Scores are whole numbers of bounded size (a gain is below 1000 ln 2^63, the noise below 23,000),
    so their histogram reaches the driver whole. It gives the lowest drawn score; only rows from
    there on are sorted, by ranges of (score, id). ``scored`` should be a written table: it is read
    three times."""
    scored = scored.drop(rank)
    eligible = F.col(name)["n_words"] >= min_words
    counts = {r["score"]: r["n"] for r in scored.filter(eligible).groupBy(F.col(name)["score"].alias("score"))
              .agg(F.count("*").alias("n")).collect()}
    k = sum(counts.values()) * percent // 100
    none = F.lit(None).cast("long")
    if not k:
        return scored.withColumn(rank, none)
    seen, lowest = 0, None
    for lowest in sorted(counts, reverse=True):
        seen += counts[lowest]
        if seen >= k:
            break
    best = eligible & (F.col(name)["score"] >= lowest)
    place = fresh(scored, "place")
    ranked = sequential_id(scored.filter(best), [F.col(name)["score"].desc(), F.col(f"`{doc_id}`").asc_nulls_first()], place)
    rest = scored.filter(~best).withColumn(rank, none)
    return ranked.withColumn(rank, F.when(F.col(place) <= k, F.col(place))).drop(place).unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 10,
             min_words: int = 20, name: str = "importance", **options) -> DataFrame:
    """The drawn documents, with the columns of ``docs``; the scored table is written once."""
    rank = fresh(docs, "rank")
    name = fresh(docs, name)
    scored = written(importance_scores(docs, target, doc_id, text, name=name, **options), "importance")
    return with_ranks(scored, doc_id, percent, min_words, name, rank).filter(F.col(rank).isNotNull()).select(
        *[F.col(f"`{c}`") for c in docs.columns])
