"""Lookup tables and membership."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def min_per_key(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str,
    clean: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per key with the smallest value; nulls count only when there is nothing else.

    Spark takes the minimum of text by sorting its input. Grouping equal pairs first is
    done by hashing, so that only distinct pairs are cleaned and sorted. The filter holds
    for every group; without it the optimizer would drop the grouping as redundant.
    """
    pairs = df.groupBy(*keys, value).agg(F.count("*").alias("__rows")).where("__rows > 0")
    cleaned = clean(F.col(value)) if clean else F.col(value)
    return pairs.groupBy(*keys).agg(F.min(cleaned).alias(name))


def semi_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``.

    The distinct changes no row of the result; it makes the map tasks fold repeated
    keys, so a key that fills the right side is not shuffled row by row.
    """
    return left.join(right.select(on).distinct(), on, "left_semi")
