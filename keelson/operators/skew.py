"""Parallelism and skew profiles.

Profiles are computed on the data, not scraped from a UI: rows per partition, and
the distribution of rows per key. Both are aggregates whose output is bounded (one
row per partition / one row in total).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The quantiles reported by the skew profile.
QUANTILES = [0.25, 0.5, 0.75, 0.95]


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per physical partition (X1, F20 ``spark_partition_id``): (partition, rows)."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def partition_count(df: DataFrame) -> DataFrame:
    """Number of non-empty partitions (A10): distinct partition ids, counted."""
    return df.select(F.spark_partition_id().alias("p")).distinct().agg(F.count(F.lit(1)).alias("partitions"))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key (A3); combines map side, so skew does not hurt it."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def skew_profile(df: DataFrame, key: str) -> DataFrame:
    """Distribution of rows per key (X2, A15): keys, min, p25, p50, p75, p95, max and
    max/median. Keys are first counted per count value, so the exact ``percentile``, weighted
    by that, sees one row per distinct *count value* c1 < c2 < ... < ck. They add up to at
    most the row count N, so k <= sqrt(2N), however many keys there are."""
    kc = key_counts(df, key).groupBy("n").agg(F.count(F.lit(1)).alias("f"))
    qs = {f"p{int(q * 100)}": F.percentile(F.col("n"), F.lit(q), F.col("f")) for q in QUANTILES}
    g = kc.agg(F.sum("f").alias("keys"), F.min("n").alias("min_rows"),
               *[v.alias(k) for k, v in qs.items()], F.max("n").alias("max_rows"))
    return g.withColumn("max_over_median", F.col("max_rows") / F.col("p50"))


# ---- mergeable sketches ---------------------------------------------------------------------


def sketches(df: DataFrame, key: str, value: str, by: list[str] | None = None, items: int = 4096, k: int = 400) -> DataFrame:
    """One row (or one for each ``by``) with the sketches ``heavy`` (frequent values of ``key``) and
    ``spread`` (quantiles of the double ``value``) and the count ``rows``: one pass, combined map-side, so
    the fact is never shuffled by its key (A15, X2). Sketches of parts can be stored and merged later."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.call_function("approx_top_k_accumulate", F.col(key), F.lit(items)).alias("heavy"),
            F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("spread")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def merged(parts: DataFrame, items: int = 4096, k: int = 400) -> DataFrame:
    """The sketches of all parts as one row."""
    return parts.agg(F.sum("rows").alias("rows"), F.call_function("approx_top_k_combine", F.col("heavy"), F.lit(items)).alias("heavy"),
                     F.kll_merge_agg_double("spread", F.lit(k)).alias("spread"))


def heavy_keys(sketch: DataFrame, most: int = 20) -> DataFrame:
    """(key, n): the most frequent values, by estimated count. A count is off by less than 4 rows in
    ``items``; a value with a larger share is never missed."""
    top = F.call_function("approx_top_k_estimate", F.col("heavy"), F.lit(most))
    return sketch.select(F.explode(top).alias("x")).select(F.col("x.item").alias("key"), F.col("x.count").alias("n"))


def sketched_quantiles(sketch: DataFrame, quantiles: list[float] = QUANTILES) -> DataFrame:
    """(p, value) for each of ``quantiles``: with k = 400 the rank is off by about one in a hundred."""
    at = F.array(*[F.struct(F.lit(p).alias("p"), F.kll_sketch_get_quantile_double(F.col("spread"), F.lit(p)).alias("value")) for p in quantiles])
    return sketch.select(F.explode(at).alias("x")).select("x.p", "x.value")
