"""Dropping rows that cannot find a partner before they are shuffled for it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.operators.joins import Key, _side, common_type
from blotter.sources import stored
from blotter.sources.tables import column

#: Bits of the filter: at least so many per key, so that about one in 16 others passes, and never more than
#: ``MOST_BITS``. 64 of them are a row, so what is broadcast has at most 2**20 rows of 16 bytes.
BITS_PER_KEY, LEAST_BITS, MOST_BITS = 16, 1 << 10, 1 << 26

WORD, MASK = "__word", "__mask"


def might_match(left: DataFrame, right: DataFrame, on: Sequence[Key], most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``left`` but for most of those whose key is not in ``right``; none that matches is lost.

    A Bloom filter with one hash function: a table of the bits that the keys of ``right`` set, 64 a row, is
    sent to all tasks and joined to the hash of the left key. Its size is bounded by ``most_bits``,
    whatever the size of ``right``; with more keys than bits it drops little, and costs little. Null keys, which no
    inner join returns, are dropped. Building it runs jobs over ``right``.
    """
    keys = [(key, key) if isinstance(key, str) else key for key in on]
    kinds = [common_type(left, right, a, b) for a, b in keys]
    rights = [column(b).cast(kind) for (_, b), kind in zip(keys, kinds)]
    present = [value.isNotNull() for value in rights]
    hashes = right.where(_all(present)).select(F.xxhash64(*rights).alias("hash"))
    rows = stored(hashes.distinct(), "key-hashes")
    bits = _power_of_two(BITS_PER_KEY * rows.count(), most_bits)
    place = F.pmod(F.col("hash"), F.lit(bits))
    words = rows.groupBy((place / 64).cast("long").alias(WORD)).agg(F.bit_or(_bit(place)).alias(MASK))

    lefts = [column(a).cast(kind) for (a, _), kind in zip(keys, kinds)]
    named = left.where(_all([value.isNotNull() for value in lefts]))
    at = F.pmod(F.xxhash64(*(_side("l", a).cast(kind) for (a, _), kind in zip(keys, kinds))), F.lit(bits))
    condition = ((at / 64).cast("long") == F.col(f"w.{WORD}")) & (_bit(at).bitwiseAND(F.col(f"w.{MASK}")) != 0)
    return named.alias("l").join(F.broadcast(words.alias("w")), condition, "left_semi")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))


def _all(conditions: Sequence[Column]) -> Column:
    held = F.lit(True)
    for condition in conditions:
        held = held & condition
    return held


def _power_of_two(least: int, most: int) -> int:
    bits = LEAST_BITS
    while bits < min(least, most):
        bits *= 2
    return bits
