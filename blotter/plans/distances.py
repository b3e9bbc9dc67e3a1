"""Distance from incidents to the station in charge."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions import haversine_km, in_year
from blotter.operators import copartition, equi_join, pair_join
from blotter.sources import compare_digests, digest, stored
from blotter.sources.extracts import year_column
from blotter.sources.tables import column

# First and last weapon code counted, both inclusive.
WEAPON_CODES = (100, 199)

AREA_OF_STATION = [("AREA", "PREC")]


def distance_by_division(
    incidents: DataFrame, stations: DataFrame, strategy: str | None = "broadcast"
) -> DataFrame:
    """DIVISION, avg_distance_km, incidents total; most incidents first.

    Rows without a usable position (a coordinate is 0 or missing) or with another
    weapon are left out.
    """
    located = incidents.where(
        (F.col("LAT") != 0) & (F.col("LON") != 0) & F.col("Weapon Used Cd").between(*WEAPON_CODES)
    ).select("AREA", "LAT", "LON")
    joined = equi_join(
        located, stations.select("DIVISION", "PREC", "x", "y"), AREA_OF_STATION, strategy
    )
    distance = haversine_km(F.col("LAT"), F.col("LON"), F.col("y"), F.col("x"))
    return (
        joined.groupBy("DIVISION")
        .agg(
            F.round(F.avg(distance), 3).alias("avg_distance_km"),
            F.count("*").alias("incidents total"),
        )
        .orderBy(F.desc("incidents total"), "DIVISION")
    )


def counts_by_division(joined: DataFrame, year: int) -> DataFrame:
    """DIVISION, incidents in one year, ordered by division."""
    return _counts(joined, year).orderBy("DIVISION")


def compare_joins(incidents: DataFrame, stations: DataFrame, year: int) -> DataFrame:
    """The counts by division over each join variant: variant, DIVISION, incidents.

    Every variant reads its input more than once, so the columns and rows they need
    are stored first and the incidents themselves are scanned once.
    """
    incidents = stored(
        incidents.where(in_year(F.col("DATE OCC"), year, year_column(incidents))).select("DATE OCC", "AREA"),
        "incidents-of-year",
    )
    variants = _variants(incidents, stations.select("DIVISION", "PREC"))
    counts = [
        _counts(joined, year).select(F.lit(name).alias("variant"), "DIVISION", "incidents")
        for name, joined in variants.items()
    ]
    return reduce(DataFrame.unionAll, counts).orderBy("variant", "DIVISION")


def compare_join_rows(incidents: DataFrame, stations: DataFrame, partitions: int) -> DataFrame:
    """Each join variant against the plain join, row by row: variant, key, expected_rows, found_rows, matches.

    Rows are compared as sets with repetitions, by key: their number and the sum of their hashes. A key
    that only one of the joins has is listed, too. Incidents are scanned once; what meets in the
    end is a row per key and variant. ``partitions`` is the number of buckets of the stored variant.
    """
    incidents, stations = stored(incidents, "incidents"), stored(stations, "stations")
    variants = _variants(incidents, stations)
    variants["bucketed"] = copartition(incidents, stations, AREA_OF_STATION, partitions).join()
    return compare_rows(variants.pop("plain"), variants, "AREA")


def compare_rows(expected: DataFrame, variants: Mapping[str, DataFrame], key: str) -> DataFrame:
    """DataFrames that should have the rows of ``expected``: variant, key, expected_rows, found_rows, matches."""
    names = sorted(expected.columns)

    def digests(df: DataFrame) -> DataFrame:
        return df.groupBy(column(key).alias("key")).agg(*digest([column(name) for name in names]))

    expected = stored(digests(expected), "expected-digests")
    compared = [
        compare_digests(expected, digests(df), ["key"], ["expected", "found"]).withColumn("variant", F.lit(name))
        for name, df in variants.items()
    ]
    rows = reduce(DataFrame.unionByName, compared)
    return rows.select("variant", "key", "expected_rows", "found_rows", "matches")


def _variants(incidents: DataFrame, stations: DataFrame) -> dict[str, DataFrame]:
    pairs = pair_join(incidents, stations, AREA_OF_STATION[0])
    return {
        "plain": equi_join(incidents, stations, AREA_OF_STATION),
        "broadcast": equi_join(incidents, stations, AREA_OF_STATION, "broadcast"),
        "repartition": equi_join(incidents, stations, AREA_OF_STATION, "repartition"),
        "copartitioned": pairs.select("left.*", "right.*"),
    }


def _counts(joined: DataFrame, year: int) -> DataFrame:
    return (
        joined.where(in_year(F.col("DATE OCC"), year))
        .groupBy("DIVISION")
        .agg(F.count("*").alias("incidents"))
    )
