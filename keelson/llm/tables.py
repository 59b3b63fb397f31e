"""Intermediate tables and checked broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

# Rows of a few fixed-width columns that may be broadcast: some 50 MB at most.
BROADCAST_ROWS = 1_000_000


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use yet."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and read again by an executor that
    takes over a lost one's work."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of fixed-width columns, marked for broadcast if its row count allows it;
    beyond that the join shuffles both sides. Either way the join has the same result."""
    return F.broadcast(df) if df.count() <= rows else df
