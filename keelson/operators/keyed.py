"""Per-key selection as an aggregate.

A plain key-partitioned window sends every row of a key to one task; a key holding a
third of the data then runs in a single task. Here "first/last row per key" is an
aggregate, ``min/max(struct(order..., rest...))``, which always combines map-side
(partial aggregation): a hot key is reduced inside every input task before the
shuffle and the reducer sees one partial row per task. (Spark 3.5+ plans the same
shape for a literal ``row_number() ... = 1`` filter via a partial WindowGroupLimit;
the aggregate form does not depend on that rule recognizing the filter, and also
serves the "last" fold of time travel.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PACK = "__pack"


def _ordered_struct(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> tuple[Column, list[str]]:
    """struct(order..., every non-key column...): compared field by field, so the
    order decides first and the remaining columns break ties."""
    order_cols = [(F.col(o) if isinstance(o, str) else o).alias(f"__o{i}") for i, o in enumerate(order)]
    rest = [c for c in df.columns if c not in keys]
    fields = order_cols + [F.col(c).alias(f"__v_{c}") for c in rest]
    return F.struct(*fields), rest


def _first_or_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], last: bool) -> DataFrame:
    keys = list(keys)
    packed, rest = _ordered_struct(df, keys, order)
    agg = F.max(packed) if last else F.min(packed)
    out = df.groupBy(*keys).agg(agg.alias(_PACK))
    return out.select(*[F.col(c) if c in keys else F.col(f"{_PACK}.__v_{c}").alias(c) for c in df.columns])


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key by ``order`` (W1); remaining columns break ties,
    so the result is deterministic even when ``order`` ties (struct comparison goes
    field by field, NULLs first)."""
    return _first_or_last(df, keys, order, last=False)


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the last row per key by ``order`` (the fold behind time travel)."""
    return _first_or_last(df, keys, order, last=True)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their count (M2, Q2). NULL keys are not
    duplicates of each other (plain ``=`` never matches NULL)."""
    notnull = None
    for k in keys:
        cond = F.col(k).isNotNull()
        notnull = cond if notnull is None else notnull & cond
    return (df.filter(notnull).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if ``keys`` repeat (merge precondition, M2); probes with ``limit(1)``."""
    if not duplicate_keys(df, keys).limit(1).isEmpty():
        raise ValueError(f"duplicate source keys on {list(keys)}: merge would be ambiguous")
