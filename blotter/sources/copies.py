"""Whether copies of a table hold the same rows.

The digest of a set of rows is their number and the sum of their hashes, so neither order nor
partitions matter, parts can be added up, and a changed, missing or doubled row shows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CopyMismatch(ValueError):
    """Copies that should hold the same rows do not."""


def digest(values: Sequence[Column]) -> list[Column]:
    """Aggregates ``rows`` and ``hashes`` over rows of these values. Null is a value of its own."""
    # The hash function skips nulls, so each value goes with whether there is one.
    told_apart = [part for value in values for part in (value, value.isNull())]
    hashed = F.xxhash64(*told_apart).cast("decimal(38,0)")
    return [F.count("*").alias("rows"), F.coalesce(F.sum(hashed), F.lit(0).cast("decimal(38,0)")).alias("hashes")]


def compare_digests(left: DataFrame, right: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Groups of two copies side by side: ``by``, the rows of each under ``<name>_rows``, ``matches``.

    ``left`` and ``right`` have a row per group with ``rows`` and ``hashes``; a group that one of
    them lacks has no rows there. Null groups are groups.
    """
    tagged = left.withColumn("_copy", F.lit(0)).unionByName(right.withColumn("_copy", F.lit(1)))

    def of(copy: int, value: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_copy") == copy, F.col(value))), F.lit(0))

    sides = tagged.groupBy(*by).agg(
        *(of(copy, "rows").cast("long").alias(f"{name}_rows") for copy, name in enumerate(names)),
        ((of(0, "rows") == of(1, "rows")) & (of(0, "hashes") == of(1, "hashes"))).alias("matches"),
    )
    return sides
