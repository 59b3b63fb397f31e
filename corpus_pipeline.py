"""The corpus pipeline: each stage's result is written as Parquet and read again as the next
stage's documents. A stage takes (spark, docs, sf_dir); all but the last return the columns of
the documents they are given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keelson.llm import cleaning, decontaminate, line_dedup, ngram_join, packing
from keelson.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line-first rules, without their failing lines."""
    return cleaning.clean(docs)


def line_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; lines that three of them share stay in the last one only."""
    return line_dedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 5-word shingles are similar by 0.8 or more."""
    return ngram_join.drop_similar(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than one word in twenty inside a window of a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 2048 words, no copies and no two pieces of one source
    in one sequence."""
    return packing.pack(docs, one_per_source=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_runs", line_runs),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("sequences", sequences),
]

# No SQL for the components of a similarity join or for best-fit packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
