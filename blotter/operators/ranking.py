"""Top rows, per group and overall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str = "rank",
) -> DataFrame:
    """Rows ranked n or better in their group; ties share a rank and are all kept.

    Filtering right on the rank lets Spark drop rows below rank n in each map task,
    so a big group does not travel whole to one task. Meant for aggregated rows.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.rank().over(window)).where(F.col(rank) <= n)


def top_k(
    df: DataFrame,
    by: str,
    k: int,
    ascending: bool = True,
    ties: Sequence[str] = (),
) -> DataFrame:
    """The k rows with the lowest or highest value; equal values are taken in order of ``ties``.

    A null value comes after all others, in either direction. Each task keeps only its own k rows.
    """
    direction = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(direction, *ties).limit(k)
