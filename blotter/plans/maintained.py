"""Reports kept up to date from stored partial results, without reading history again.

A partial result has a row per group, adds up with those of other rows, and is stored as Parquet. A new extract
becomes a partial result itself and is merged with the stored one. The merged result is written to a place of its
own, so a run that breaks off leaves the last one whole, and running it again from there gives the same.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions import text_month, text_year
from blotter.operators import min_per_key
from blotter.plans.months import TOP, busiest_months
from blotter.sources import read_parquet, write_parquet

Merge = Callable[..., DataFrame]


def month_counts(incidents: DataFrame) -> DataFrame:
    """Year, Month, crime_total: the partial result of ``top_months``."""
    date = F.col("DATE OCC")
    by = (text_year(date).alias("Year"), text_month(date).alias("Month"))
    return incidents.groupBy(*by).agg(F.count("*").alias("crime_total"))


def merge_counts(*parts: DataFrame) -> DataFrame:
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("Year", "Month").agg(F.sum("crime_total").alias("crime_total"))


def top_months_of(counts: DataFrame, n: int = TOP) -> DataFrame:
    """The report of ``top_months`` from its partial result."""
    return busiest_months(counts, n)


def merge_lookups(*parts: DataFrame) -> DataFrame:
    """LAT, LON, zip_code from lookups of parts, see ``zip_lookup``: a lookup is its own partial result."""
    return min_per_key(reduce(DataFrame.unionByName, parts), ["LAT", "LON"], "zip_code", "zip_code")


def maintain(spark: SparkSession, path: str, part: DataFrame, merge: Merge, before: str | None = None) -> DataFrame:
    """The partial result stored at ``before``, if there is one, merged with ``part`` and stored at ``path``.

    Each extract must be merged once: counts do not show what they have counted.
    """
    merged = part if before is None else merge(read_parquet(spark, before), part)
    write_parquet(merged, path)
    return read_parquet(spark, path)
