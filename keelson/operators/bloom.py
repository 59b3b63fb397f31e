"""Bloom-filter reduction of joins (J8, J9, M1) with DataFrame operators.

The filter is a table of 64-bit words: a key's hash picks one word and a few bits in it, and the words
are the bitwise or over all keys. It is broadcast; a row whose word lacks one of its bits has no partner
for sure and takes no part in the shuffle. A word costs some 40 bytes and serves five keys, so keys that
are far too many to broadcast themselves can still prune the other side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.operators.joins import fits_broadcast
from keelson.operators.keyed import assert_unique

BITS_A_KEY, HASHES = 12, 4
# Words that may be broadcast: about 80 MB, eleven million keys.
MAX_WORDS = 1 << 21


def _key(keys: Sequence[str], words: int) -> tuple[Column, Column]:
    """(slot, mask) of a row's key."""
    h = F.xxhash64(*[F.col(k) for k in keys])
    again = F.xxhash64(F.lit(11), *[F.col(k) for k in keys])
    mask = F.lit(0).cast("long")
    for i in range(HASHES):
        bit = F.shiftrightunsigned(again, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return F.pmod(h, F.lit(words)).alias("__slot"), mask.alias("__mask")


def build(source: DataFrame, keys: Sequence[str], max_words: int = MAX_WORDS) -> DataFrame | None:
    """The filter (slot, word) of the keys of ``source``; None if it would take more than
    ``max_words`` words. Rows with a null key are left out: they match nothing."""
    keys = list(keys)
    some = source.select(*keys).dropna()
    words = max(1, -(-some.count() * BITS_A_KEY // 64))
    if words > max_words:
        return None
    slot, mask = _key(keys, words)
    return (some.select(slot, mask).groupBy("__slot").agg(F.bit_or("__mask").alias("__word"))
                .withColumn("__words", F.lit(words)))


def split(target: DataFrame, bloom: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that may have a partner, rows that surely have none). Both stream the target past the
    broadcast words; no row is in both."""
    words = bloom.select("__words").first()
    if words is None:                                              # no keys at all
        return target.limit(0), target
    slot, mask = _key(list(keys), words[0])
    table = F.broadcast(bloom.select(F.col("__slot").alias("__s"), F.col("__word").alias("__w")))
    hit = (slot == F.col("__s")) & (F.col("__w").bitwiseAND(mask) == mask)
    return target.join(table, hit, "left_semi"), target.join(table, hit, "left_anti")


def upsert_reduced(target: DataFrame, source: DataFrame, keys: Sequence[str], check_unique: bool = True,
                   max_words: int = MAX_WORDS) -> DataFrame:
    """``versions.upsert`` for a source whose keys are too many to broadcast (M1, J9): target rows
    without a key in the filter are kept as they stream by, only the others are shuffled to the
    anti-join. ``source`` and ``target`` should be tables, as both are read twice. Falls back to the
    plain anti-join where the filter would be too large."""
    keys = list(keys)
    if check_unique:
        assert_unique(source, keys)
    only = source.select(*keys).dropna()
    if fits_broadcast(only):
        kept = target.join(F.broadcast(only), keys, "left_anti")
    elif (bloom := build(source, keys, max_words)) is None:
        kept = target.join(only, keys, "left_anti")
    else:
        maybe, clear = split(target, bloom, keys)
        kept = clear.unionByName(maybe.join(only.hint("merge"), keys, "left_anti"))
    return kept.unionByName(source, allowMissingColumns=True)


def orphans_reduced(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, max_words: int = MAX_WORDS) -> DataFrame:
    """``joins.orphans`` for a parent that is small against the child but too large to broadcast (J8):
    child rows without a word in the filter are orphans at once, and only the rest is looked up."""
    some = child.filter(F.col(child_key).isNotNull())
    own = parent.select(F.col(parent_key).alias(child_key))
    bloom = build(own, [child_key], max_words)
    if bloom is None:
        return some.join(own.distinct(), child_key, "left_anti").select(*child.columns)
    maybe, clear = split(some, bloom, [child_key])
    return clear.unionByName(maybe.join(own.distinct().hint("merge"), child_key, "left_anti").select(*child.columns))
